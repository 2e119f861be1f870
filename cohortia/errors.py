"""Named failures, so that a stage can report why it stopped."""


class InvalidDefinition(ValueError):
    """A recipe or configuration is malformed."""


class InsufficientData(ValueError):
    """A class has too few users to train on."""


class EmptyInput(ValueError):
    """An input that must hold rows holds none."""


class Conflict(RuntimeError):
    """Another writer changed a table in the meantime."""


class ScoringError(Exception):
    """Base of the typed scoring failures; ``status`` is what history records."""

    status = "failed"


class MissingFeatures(ScoringError):
    status = "MissingFeaturesError"


class MissingHistory(ScoringError):
    status = "MissingHistoryError"


class MissingModel(ScoringError):
    status = "MLFlowDependenceError"
