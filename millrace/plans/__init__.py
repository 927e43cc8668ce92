"""Query plans: operators wired to domain views over the given tables."""

from importlib import import_module

MODULES = ("scoring", "rounds", "corpus", "messages", "logs", "vocabulary", "retrieval", "edits", "code", "rules", "streams", "admission", "assembly", "markup", "api")


def load():
    """The registry with all modules' queries in it."""
    for name in MODULES:
        import_module(f"millrace.plans.{name}")
    return import_module("millrace.plans.registry")
