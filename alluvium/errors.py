"""Errors of the library; a stage wraps what its parts raise."""


class PipelineError(Exception):
    """Root of the errors that end a run."""


class ExtractError(PipelineError):
    pass


class TransformError(PipelineError):
    pass


class LoadError(PipelineError):
    pass


class ScraperError(ExtractError):
    """A page that can't tell what comes after it."""


class ParserError(TransformError):
    pass


class ConfigError(PipelineError):
    pass
