from brindle.functions.json import extract
from brindle.functions.text import lower_columns

__all__ = ["extract", "lower_columns"]
