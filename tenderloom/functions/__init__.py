"""Column functions."""

from tenderloom.functions import amounts, dates, keys, links, phones, text

__all__ = ["amounts", "dates", "keys", "links", "phones", "text"]
