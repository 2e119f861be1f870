"""Queries over the test tables, each with an independent SQL statement."""


def registry() -> dict:
    """All registered queries: ``{name: (run, sql or None)}``."""
    import importlib

    from checks import views

    for module in MODULES:
        importlib.import_module(f"checks.{module}")
    return dict(views.REGISTRY)


MODULES = ["scans", "labels", "joins", "shapes", "models", "stages"]
