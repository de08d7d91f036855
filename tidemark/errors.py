"""Exceptions raised on the driver."""


class TidemarkError(Exception):
    """Base class of every error this package raises on purpose."""


class ContractError(TidemarkError):
    """The declared contract is inconsistent."""


class QualityGateError(TidemarkError):
    """Blocking quality issues were found, so nothing is published."""
