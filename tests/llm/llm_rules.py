"""Word rules of the contracts, restated for the tests."""

import re


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
