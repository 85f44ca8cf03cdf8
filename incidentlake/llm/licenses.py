"""License scans: templates with optional and replaceable regions, compiled to token automata.

Markup of a template: ``<<beginOptional>>`` .. ``<<endOptional>>`` (may be nested),
``<<var;match=a|b c>>`` (one of the given wordings) and ``<<var;max=n>>`` (up to n words of any
kind). Everything else is mandatory wording. A text has a template's label if its words hold,
somewhere, a run that the automaton accepts: all mandatory words in order, nothing between them
but what the regions allow. Case (A-Z), punctuation and white space do not matter.

Base labels are plain phrases. A null or empty text has no words, no labels and score 0; texts
are taken whole whatever their length; every input row gives one row, repeated rows included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import rename, ship

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

#: Fixed values of the contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_GRANT = "<<var;match=licensed|released|distributed|published|available|provided>> under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>><<var;match=a|an|the>><<endOptional>>"
TEMPLATES = {
    "apache-2.0": _GRANT + " Apache License<<beginOptional>>, Version<<endOptional>> 2.0",
    "bsd": _GRANT + " BSD <<beginOptional>><<var;match=2|3|4>>-Clause<<endOptional>> License",
    "cc-by-4.0": _GRANT + " <<var;match=CC BY|Creative Commons Attribution>> 4.0",
    "cc-by-nc-4.0": _GRANT + " <<var;match=CC BY-NC|Creative Commons Attribution-NonCommercial>> 4.0",
    "cc-by-sa-4.0": _GRANT + " <<var;match=CC BY-SA|Creative Commons Attribution-ShareAlike>> 4.0",
    "cc0-1.0": _GRANT + " <<var;match=CC0|Creative Commons Zero>> <<beginOptional>>Version<<endOptional>> 1.0",
    "gpl-2.0": _GRANT + " GNU General Public License<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 2",
    "gpl-3.0": _GRANT + " GNU General Public License<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 3",
    "holder-reserved": "Copyright <<beginOptional>>(c)<<endOptional>> <<var;max=8>> All rights reserved",
    "lgpl": _GRANT + " GNU <<var;match=Lesser|Library>> General Public License",
    "mit": "<<var;match=licensed|released|distributed|published|available|provided>> under <<beginOptional>>the terms of<<endOptional>> <<var;match=the|an>> MIT License",
    "mit-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this <<var;match=software|work>> <<beginOptional>>and associated documentation <<var;match=files|material>><<endOptional>> <<beginOptional>>(the "<<var;max=2>>"),<<endOptional>> to deal in <<var;max=2>> without restriction',
    "mpl-2.0": _GRANT + " Mozilla Public License<<beginOptional>>, <<var;match=v|version>><<endOptional>> 2.0",
    "public-domain": "dedicated to the public domain",
}


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased. Bytes from 0x80 on belong to words, as in the code points they spell."""
    return WORD.findall((text or "").encode().lower())


def parsed(template: str) -> list:
    """Nested form: a word, ('opt', items), ('any', n) or ('alt', [words, ...])."""
    stack: list[list] = [[]]
    for part in re.split(r"(<<.*?>>)", template):
        if part == "<<beginOptional>>":
            stack.append([])
        elif part == "<<endOptional>>":
            inner = stack.pop()
            stack[-1].append(("opt", inner))
        elif part.startswith("<<var;max="):
            stack[-1].append(("any", int(part[10:-2])))
        elif part.startswith("<<var;match="):
            stack[-1].append(("alt", [words_of(x) for x in part[12:-2].split("|")]))
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            stack[-1] += words_of(part)
    if len(stack) != 1:
        raise ValueError("an optional region is not closed")
    return stack[0]


class Automaton:
    """States with word, any-word and empty moves. State 0 is the start, ``end`` accepts."""

    def __init__(self, template: str):
        self.by_word: list[dict[bytes, list[int]]] = [{}]
        self.any_word: list[list[int]] = [[]]
        self.empty: list[list[int]] = [[]]
        items = parsed(template)
        self.end = self._items(items, 0)
        self.needed = [w for w in items if isinstance(w, bytes)]
        self.reach = [self._closure(s) for s in range(len(self.empty))]
        if not self.needed or any(self.any_word[s] for s in self.reach[0]) or self.end in self.reach[0]:
            raise ValueError("a template needs mandatory wording and must not begin with free words")
        self.starts = {w for s in self.reach[0] for w in self.by_word[s]}

    def _state(self) -> int:
        for moves in (self.by_word, self.any_word, self.empty):
            moves.append({} if moves is self.by_word else [])
        return len(self.empty) - 1

    def _items(self, items: list, at: int) -> int:
        for item in items:
            to = self._state()
            if isinstance(item, bytes):
                self.by_word[at].setdefault(item, []).append(to)
            elif item[0] == "opt":
                self.empty[at].append(to)
                self.empty[self._items(item[1], at)].append(to)
            elif item[0] == "alt":
                for words in item[1]:
                    self.empty[self._items(words, at)].append(to)
            else:
                here = at
                self.empty[here].append(to)
                for _ in range(item[1]):
                    following = self._state()
                    self.any_word[here].append(following)
                    self.empty[following].append(to)
                    here = following
            at = to
        return at

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def accepts(self, words: list[bytes], start: int) -> bool:
        """Whether a run of words from ``start`` on is accepted."""
        now = self.reach[0]
        for k in range(start, len(words)):
            word = words[k]
            following: set[int] = set()
            for s in now:
                for t in (*self.by_word[s].get(word, ()), *self.any_word[s]):
                    following |= self.reach[t]
            if self.end in following:
                return True
            if not following:
                return False
            now = following
        return False


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.automata = {label: Automaton(t) for label, t in templates.items()}
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        low = (text or "").encode().lower()
        mask = _IS_WORD[np.frombuffer(low, np.uint8)]
        n_words = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + bool(len(mask) and mask[0])
        # a text without a template's or phrase's mandatory words cannot hold it
        automata = [(label, a) for label, a in self.automata.items() if all(w in low for w in a.needed)]
        phrases = [(p, label) for p, label in self.phrases if all(w in low for w in p)]
        if not automata and not phrases:
            return n_words, 0, None, None, "", "", 0.0
        words = WORD.findall(low)
        places, base = [], set()
        for phrase, label in phrases:
            for k, word in enumerate(words):
                if word == phrase[0] and words[k:k + len(phrase)] == phrase:
                    places.append(k)
                    base.add(label)
        found = {label for label, a in automata if any(w in a.starts and a.accepts(words, k) for k, w in enumerate(words))}
        return (
            n_words, len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if found else 0.5 if base else 0.0)


_SCANNERS: dict[str, Scanner] = {}
COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: counts, places and labels; ``score`` is 1 with a template, 0.5 with a phrase alone.

    Nothing is shuffled; the templates travel with the task.
    """
    ship(docs.sparkSession)
    given = (templates or TEMPLATES, phrases or PHRASES)
    kept = rename(docs, id=id_col, text=text_col)
    id_type = kept.schema["id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = repr(given)
        if key not in _SCANNERS:
            _SCANNERS[key] = Scanner(*given)
        scan = _SCANNERS[key].scan
        for frame in frames:
            out = pd.DataFrame([scan(t) for t in frame["text"]], columns=COLUMNS)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            out.insert(0, "id", frame["id"].to_numpy())
            yield out

    return kept.mapInPandas(run, f"id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double").withColumnRenamed("id", id_col)


def _pattern(items: list) -> str:
    """A template as a regular expression over words that each end in a space."""
    out = ""
    for item in items:
        if isinstance(item, bytes):
            out += item.decode() + " "
        elif item[0] == "opt":
            out += f"(?:{_pattern(item[1])})?"
        elif item[0] == "any":
            out += f"(?:[^ ]+ ){{0,{item[1]}}}"
        else:
            out += "(?:" + "|".join(_pattern(x) for x in item[1]) + ")"
    return out


def sql(templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> str:
    """The same scan in DuckDB's SQL, with regular expressions in place of automata."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places, cases = [], []
    for phrase, label in phrases.items():
        words = [w.decode() for w in words_of(phrase)]
        test = " AND ".join(f"words[k + {j + 1}] = '{w}'" for j, w in enumerate(words))
        places.append(f"[k FOR k IN range(len(words)) IF {test}]")
        cases.append(f"CASE WHEN len([k FOR k IN range(len(words)) IF {test}]) > 0 THEN '{label}' END")
    found = [f"CASE WHEN regexp_matches(joined, ' {_pattern(parsed(t))}') THEN '{label}' END" for label, t in templates.items()]
    labels = lambda x: f"coalesce(array_to_string(list_sort(list_distinct([x FOR x IN {x} IF x IS NOT NULL])), ','), '')"
    return rf"""
WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words FROM documents),
j AS (SELECT doc_id, words, ' ' || coalesce(array_to_string(words, ' '), '') || ' ' AS joined,
  {' || '.join(places)} AS places, [{', '.join(cases)}] AS base FROM w),
f AS (SELECT *, [{', '.join(found)}] AS found FROM j)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  {labels('base')} AS base_labels, {labels('base || found')} AS labels,
  CASE WHEN len([x FOR x IN found IF x IS NOT NULL]) > 0 THEN 1.0::DOUBLE
    WHEN len(places) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score FROM f"""
