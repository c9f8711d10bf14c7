"""Published versions of the layers: built aside, made visible by one commit, readable for as long as they are kept.

A draft is a lake folder of its own under ``versions``. A commit says in which folder each table of a version lies.
Readers resolve the commit once and then read those folders alone, so a build that stops half way, or one that runs at
the same time, changes nothing for them. Publishing copies no data, and versions may share tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from medledger.sources import commits
from medledger.sources.lake import Lake

#: Kinds of versions: raw tables that wait for their marts, and whole ones for readers.
LANDED, PUBLISHED = "landed", "published"


class NoVersion(LookupError):
    """Nothing, or not the version asked for, has been published."""


@dataclass(frozen=True)
class Version:
    number: int
    root: Lake
    about: dict

    def read(self, layer: str, name: str) -> DataFrame:
        return Lake(self.root.spark, f"{self.root.root}/{self.about['tables'][layer][name]}").read(layer, name)

    def tables(self, layer: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return {n: self.read(layer, n) for n in (self.about["tables"][layer] if names is None else names)}

    def places(self, layer: str) -> dict[str, Lake]:
        """Where each table of the layer lies, for a version that shares it."""
        return {n: Lake(self.root.spark, f"{self.root.root}/{f}") for n, f in self.about["tables"][layer].items()}

    def folders(self) -> set[str]:
        return {f for names in self.about["tables"].values() for f in names.values()}


def _commits(lake: Lake, kind: str) -> str:
    return lake.path("commits", kind)


def draft(lake: Lake) -> Lake:
    """A new, empty folder that no reader knows of."""
    return Lake(lake.spark, lake.path("versions", uuid.uuid4().hex))


def publish(lake: Lake, tables: dict[str, dict[str, Lake]], kind: str = PUBLISHED, **about) -> Version:
    """Make ``tables`` (layer -> name -> the lake folder it is stored in) the newest version.

    Each table must be stored whole, at or under ``lake``. Versions published at the same time get numbers of their own;
    the higher one is the newest.
    """
    found: dict[str, dict[str, str]] = {}
    for layer, names in tables.items():
        for name, made in names.items():
            if made.root != lake.root and not made.root.startswith(f"{lake.root}/"):
                raise ValueError(f"{layer}/{name} is not stored under {lake.root}")
            if not commits.exists(lake.spark, f"{made.path(layer, name)}/_SUCCESS"):
                raise ValueError(f"{layer}/{name} is not stored whole: there is no end mark of its write")
            found.setdefault(layer, {})[name] = made.root[len(lake.root) + 1:] or "."
    content = {"tables": found, **about}
    return Version(commits.claim_next(lake.spark, _commits(lake, kind), content), lake, content)


def numbers(lake: Lake, kind: str = PUBLISHED) -> list[int]:
    return commits.numbers(lake.spark, _commits(lake, kind))


def open_version(lake: Lake, number: int | None = None, kind: str = PUBLISHED) -> Version:
    """The newest version, or the one of that number, resolved once."""
    known = numbers(lake, kind)
    if not known or number not in (None, *known):
        raise NoVersion(f"no {kind} version {number or ''} under {lake.root}")
    number = known[-1] if number is None else number
    return Version(number, lake, commits.read(lake.spark, _commits(lake, kind), number))


def expire(lake: Lake, keep: int) -> list[int]:
    """Delete all published versions but the newest ``keep``, and landed ones but the newest: first their commits, so
    that no reader finds them, then the folders that no version left refers to.

    A reader that opened one of them before must be done; choose ``keep`` by how long reads last. Folders of builds that
    were never published are left alone: one may still be running.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    gone = [(LANDED, n) for n in numbers(lake, LANDED)[:-1]] + [(PUBLISHED, n) for n in numbers(lake)[:-keep]]
    folders = set()
    for kind, n in gone:
        folders |= open_version(lake, n, kind).folders()
        commits.remove(lake.spark, _commits(lake, kind), n)
    for kind in (LANDED, PUBLISHED):
        for n in numbers(lake, kind):
            folders -= open_version(lake, n, kind).folders()
    for folder in sorted(folders - {"."}):
        commits.delete_folder(lake.spark, f"{lake.root}/{folder}")
    return [n for kind, n in gone if kind == PUBLISHED]
