from haulmark.functions import clock, lookup, numbers, text  # noqa: F401
