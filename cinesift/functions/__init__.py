from cinesift.functions.genres import genre_array, sorted_genre_list
from cinesift.functions.keys import restrict
from cinesift.functions.titles import normalise_title_key, title_key, title_year

__all__ = [
    "genre_array",
    "normalise_title_key",
    "restrict",
    "sorted_genre_list",
    "title_key",
    "title_year",
]
