"""Import every module that registers queries."""

_loaded = False


def load() -> None:
    global _loaded
    if _loaded:
        return
    from cropcube.plans import catalog, ml_queries, outputs, stream_queries  # noqa: F401
    _loaded = True
