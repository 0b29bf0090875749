from slipstream.sources import archive, index

__all__ = ["archive", "index"]
