"""Errors raised by the library, one type per kind of broken expectation."""


class PanelError(RuntimeError):
    """Base class of every error this library raises on purpose."""


class MissingInputError(PanelError):
    """An input table or file is absent, unreadable or empty."""


class ContractError(PanelError):
    """Data or schema breaks a declared contract (keys, coverage, columns)."""


class ListFormatError(PanelError, ValueError):
    """A user-supplied key list cannot be read as a list of keys."""
