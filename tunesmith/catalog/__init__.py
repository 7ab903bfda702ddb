"""Every operator bound to the test tables, with the SQL that checks it."""

from tunesmith.catalog import chat, evaluation, inference, metrics, records, selection, tokens
from tunesmith.catalog.registry import Entry

GROUPS = (records, selection, chat, tokens, inference, evaluation, metrics)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for group in GROUPS:
        for name, entry in group.ENTRIES.items():
            if name in found:
                raise ValueError(f"registered twice: {name}")
            found[name] = entry
    return found
