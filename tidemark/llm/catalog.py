"""All queries of the subpackage and their oracle SQL."""

from importlib import import_module

MODULES = ("quality", "tokens", "urls", "html", "warc", "jaccard", "toxicity", "lm", "decontaminate", "trie", "search", "idfile")


def queries() -> dict:
    out = {}
    for name in MODULES:
        out |= import_module(f"{__package__}.{name}").QUERIES
    return out


def oracle_sql() -> dict:
    out = {}
    for name in MODULES:
        out |= import_module(f"{__package__}.{name}").ORACLES
    return out
