from slipstream.functions import jsonwalk, parse

__all__ = ["jsonwalk", "parse"]
