"""Name -> query function, and name -> check SQL."""

QUERIES: dict = {}
CHECKS: dict = {}


def query(name: str, check: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return deco
