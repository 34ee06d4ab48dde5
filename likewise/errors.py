"""Errors raised by the public operators."""


class ItemNotFound(LookupError):
    """The requested item id is not in the catalog."""

    def __init__(self, sku):
        super().__init__(f"item {sku!r} is not in the catalog")
        self.sku = sku


class TooManyAttributes(ValueError):
    """An operator's size bound on the number of attributes is exceeded."""
