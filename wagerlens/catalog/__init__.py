"""Registered queries and the SQL each one is checked against."""


def _load() -> None:
    from wagerlens.catalog import dashboards, loads, models, parts, quality, streams  # noqa: F401


def queries() -> dict:
    from wagerlens.catalog import registry

    _load()
    return dict(registry.QUERIES)


def checks() -> dict[str, str]:
    from wagerlens.catalog import registry

    _load()
    return dict(registry.CHECKS)
