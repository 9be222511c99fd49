"""The rule catalogue: which concept fills which column of which table.

The rules are plain text under ``specs/`` (one file per table).  They are read
on the driver while a plan is being built, and only turned into column
expressions, so nothing of the catalogue is shipped to or read by tasks.  A
deployment with its own concept dictionary passes its own directory.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from importlib import resources
from pathlib import Path

FORMS = (
    "contact",
    "client_enrollment",
    "clinical_visit",
    "sti_treatment",
    "peer_calendar",
    "hts_test",
    "violence_screening",
)


@dataclass(frozen=True)
class Answers:
    """Labels of a coded question; ``other`` is the label of any other code."""

    labels: tuple[tuple[int, str], ...]
    other: str | None = ""

    def distinct(self) -> list[str | None]:
        """The labels, each once, in the order in which they are listed."""
        return list(dict.fromkeys([*[label for _, label in self.labels], self.other]))

    def ranked(self) -> list[str]:
        """Distinct labels in case-insensitive order, smallest first."""
        distinct = {label for _, label in self.labels} | {self.other}
        return sorted(distinct, key=lambda label: (label.lower(), label))


@dataclass(frozen=True)
class Rule:
    """One output column.

    ``source`` is ``encounter`` (carried), ``concept`` (an observation),
    ``kit`` (a test-kit slot), ``identifier`` or ``test type``.
    """

    name: str
    type: str
    source: str
    key: str
    kind: str = ""
    answers: Answers | None = None
    flag: int | None = None

    @property
    def concept(self) -> int:
        return int(self.key)

    @property
    def width(self) -> int | None:
        """Character width of a text column, None for the other types."""
        m = re.search(r"\((\d+)\)", self.type)
        return int(m.group(1)) if m else None


@dataclass(frozen=True)
class Form:
    name: str
    columns: tuple[Rule, ...]
    kit_parts: tuple[Rule, ...] = ()

    @property
    def measures(self) -> list[Rule]:
        return [r for r in self.columns if r.source == "concept"]

    @property
    def concepts(self) -> list[int]:
        """Concepts to read: derived from the rules, so none can be forgotten."""
        found = {r.concept for r in self.measures}
        found |= {int(r.kind.split("=")[0]) for r in self.columns if r.source == "test type"}
        return sorted(found)


@dataclass(frozen=True)
class Mart:
    name: str
    source: str
    carried: tuple[str, ...]
    decoded: tuple[tuple[str, Answers], ...]
    # (column, deciding column, {value of the deciding column: answers})
    dependent: tuple[tuple[str, str, tuple[tuple[int, Answers], ...]], ...] = ()

    @property
    def everything(self) -> bool:
        return self.carried == ("*",)


def parse_answers(text: str, other: str | None = "") -> Answers:
    """Read ``code=label; code=label; else=label``; labels keep their blanks."""
    labels = []
    for part in re.split(r"; (?=-?\d+=|else=)", text):
        code, label = part.split("=", 1)
        if code == "else":
            other = label
        else:
            labels.append((int(code), label))
    return Answers(tuple(labels), other)


class Catalog:
    def __init__(self, directory: str | Path | None = None):
        self.root = Path(directory) if directory else resources.files("formfold") / "specs"
        self.shared = {
            name: parse_answers(text) for name, text in self._lines("answers.txt")
        }

    def _lines(self, *path: str):
        text = self.root.joinpath(*path).read_text(encoding="utf-8")
        for line in text.splitlines():
            if line and not line.startswith("#"):
                head, _, tail = line.partition(" | ")
                yield head, tail

    def _answers(self, text: str) -> Answers:
        return self.shared[text[1:]] if text.startswith("@") else parse_answers(text)

    @lru_cache(maxsize=None)
    def form(self, name: str) -> Form:
        columns, parts = [], []
        for column, rest in self._lines("forms", f"{name}.txt"):
            type_, source, rule = rest.split(" | ", 2)
            word, _, key = source.partition(" ")
            answers = flag = None
            kind = rule
            if source == "test type":
                word, key = source, ""
            if word == "concept" and rule.startswith("answers "):
                kind, answers = "answers", self._answers(rule[len("answers "):])
            elif word == "concept" and rule.startswith("flag "):
                kind, flag = "flag", int(rule[len("flag "):])
            elif word in ("encounter", "identifier"):
                kind, key = "", rule
            made = Rule(column.removeprefix("kit."), type_, word, key, kind, answers, flag)
            (parts if column.startswith("kit.") else columns).append(made)
        return Form(name, tuple(columns), tuple(parts))

    @lru_cache(maxsize=None)
    def mart(self, name: str) -> Mart:
        source, carried, decoded = "", [], []
        dependent: dict[str, tuple[str, list]] = {}
        for column, rule in self._lines("marts", f"{name}.txt"):
            if column == "source":
                source = rule
            elif rule == "carried":
                carried.append(column)
            elif rule.startswith("answers "):
                decoded.append((column, self._answers(rule[len("answers "):])))
            elif rule.startswith("by "):
                dependent[column] = (rule[len("by "):], [])
            else:
                target, value = re.fullmatch(r"(\w+) when \w+ (\d+)", column).groups()
                dependent[target][1].append((int(value), parse_answers(rule, other=None)))
        return Mart(
            name,
            source,
            tuple(carried),
            tuple(decoded),
            tuple((c, by, tuple(cases)) for c, (by, cases) in dependent.items()),
        )

    def marts(self) -> list[str]:
        return sorted(
            p.name.removesuffix(".txt") for p in self.root.joinpath("marts").iterdir()
        )


@lru_cache(maxsize=1)
def default_catalog() -> Catalog:
    return Catalog()
