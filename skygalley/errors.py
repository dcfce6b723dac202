class ValidationError(ValueError):
    """A request, a configuration or a dataset breaks a stated rule."""


class ModelDegradationError(RuntimeError):
    """A newly trained model is worse than the stored one by more than the allowed share."""
