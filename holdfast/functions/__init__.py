from holdfast.functions.numeric import cents, dollars, fraction, round_away
from holdfast.functions.ranges import cut_points, range_of
from holdfast.functions.rules import band, code_map, first_match, yes_count
from holdfast.functions.text import signed_text, snake_case, title_words

__all__ = [
    "band", "cents", "code_map", "cut_points", "dollars", "first_match", "fraction",
    "range_of", "round_away", "signed_text", "snake_case", "title_words", "yes_count",
]
