"""Errors of the engine. A data error carries how many rows are wrong and a few of them."""


class EngineError(Exception):
    pass


class ConfigError(EngineError):
    pass


class DataError(EngineError):
    pass
