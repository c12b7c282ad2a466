"""The allowlist of monitored pages.

An allowlist is a short list of page titles per wiki, each with aliases. It is
configuration, read on the driver; its length is therefore known before a plan
is built and decides how it is joined (see ``operators.matching``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

DEFAULT_WIKI = "enwiki"

# The default monitored pages (title, aliases), all of one wiki.
DEFAULT_PAGES = (
    ("List of WWE personnel", ("WWE personnel", "List of World Wrestling Entertainment personnel")),
    ("United States", ("USA", "United States of America")),
    ("Donald Trump", ("Donald John Trump", "45th U.S. President")),
    ("George W. Bush", ("George Walker Bush", "43rd U.S. President")),
    ("List of current UFC fighters", ("UFC fighters list", "Ultimate Fighting Championship fighters")),
    ("Legalism (Chinese philosophy)", ("Chinese Legalism", "Fajia")),
    ("Wikipedia", ("Wikipedia article", "Wiki encyclopedia")),
    ("List of Netflix original programming", ("Netflix originals", "Netflix series list")),
    ("ATP Tour records", ("ATP records", "Tennis ATP Tour records")),
    ("Michael Jackson", ("King of Pop", "Michael Joseph Jackson")),
    ("Jesus", ("Jesus Christ", "Jesus of Nazareth")),
    ("Barack Obama", ("Barack Hussein Obama", "44th U.S. President")),
    ("List of programs broadcast by ABS-CBN", ("ABS-CBN programs", "ABS CBN broadcast list")),
    ("Catholic Church", ("Roman Catholic Church", "Catholicism")),
    ("The Undertaker", ("Mark Calaway", "Undertaker WWE")),
    ("India", ("Republic of India", "Bharat")),
    ("United Kingdom", ("UK", "Great Britain and Northern Ireland")),
    ("Adolf Hitler", ("Hitler", "Adolf Hitler dictator")),
    ("World War II", ("WWII", "Second World War")),
    ("Britney Spears", ("Britney Jean Spears", "Pop singer Britney Spears")),
)


@dataclass(frozen=True)
class Needle:
    """One title or alias to look for. ``kind`` 0 is a title, 1 an alias."""

    wiki: str
    raw: str
    kind: int
    position: int
    canonical: str


def needles(entities: Iterable[Mapping]) -> list[Needle]:
    """Titles first, then aliases, each in list order and once per wiki.

    An alias given twice keeps its first place and points to the last page.
    """
    pages: dict[tuple[str, str], str] = {}
    aliases: dict[tuple[str, str], str] = {}
    for entity in entities:
        title, wiki = entity["title"], entity.get("wiki", DEFAULT_WIKI)
        canonical = f"{wiki}:{title}"
        pages.setdefault((wiki, title), canonical)
        for alias in entity.get("aliases") or ():
            aliases[(wiki, alias)] = canonical
    found = []
    for kind, group in enumerate((pages, aliases)):
        for position, ((wiki, raw), canonical) in enumerate(group.items()):
            found.append(Needle(wiki, raw, kind, position, canonical))
    return found


def default_allowlist() -> list[Needle]:
    return needles({"title": title, "aliases": aliases} for title, aliases in DEFAULT_PAGES)


def load_allowlist(path: str) -> list[Needle]:
    """Read an allowlist file: ``entities: [{title, wiki, aliases}]`` in YAML or JSON."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        config = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading a YAML allowlist needs PyYAML; give JSON instead") from error
        config = yaml.safe_load(text)
    return needles(config.get("entities") or ())
