"""How the modules of this package register their queries."""

from __future__ import annotations


def registrar(queries: dict, oracles: dict):
    """A decorator that puts a query, and the SQL to check it against, under its function's name or a given one."""

    def query(oracle: str | None, name: str | None = None):
        def register(fn):
            queries[name or fn.__name__] = fn
            if oracle is not None:
                oracles[name or fn.__name__] = oracle
            return fn

        return register

    return query
