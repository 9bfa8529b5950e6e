"""Licence notices and identifiers in documents.

Method: one Aho-Corasick automaton over notice phrases and identifier tags runs once over each text's words.  What follows
an identifier tag is read as a licence expression, which a shunting-yard parser turns into postfix form and evaluates:
``with`` binds closest and joins two identifiers, then ``and``, then ``or``.

Definition.  A-Z is lower-cased; words are runs of ASCII letters, digits and non-ASCII bytes; null text is empty.  A place
is where the words of a phrase stand consecutively; overlapping places of base phrases all count, of the phrases that this
method adds only those that lie in no longer place.  ``labels`` are those of all phrases that count and of all identifiers in
well-formed expressions of known identifiers; what follows a tag and names anything else ("see LICENSE file") is no expression.
``permissive`` is true if every notice and expression found allows use under permissive terms, false if one does not, null if
nothing was found.  ``score`` is how sure it is that the text carries a licence: names, sentences of notices and expressions each
leave a part of the doubt, ``WEIGHTS``, distinct phrases and every expression counting once.  Texts of any length are read whole, in time that grows with the length; equal rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import LOWER, batches

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
_SHORT = {"noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd"}
#: Names of licences, which a text may mention without being under them.
NAMES = {
    "mit license": "mit",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu gpl": "gpl",
    "gnu gpl v2": "gpl-2",
    "gnu gpl v3": "gpl-3",
    "gplv2": "gpl-2",
    "gplv3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "lgplv2": "lgpl-2",
    "lgplv3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "agplv3": "agpl-3",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license v 2": "mpl-2",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "apache license": "apache",
    "boost software license": "bsl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    **{
        " ".join(("creative commons attribution", *words, *version)): "-".join(("cc-by", *(_SHORT[w] for w in words), *[".".join(version)][: len(version)]))
        for words in ((), ("noncommercial",), ("sharealike",), ("noderivatives",), ("noncommercial", "sharealike"), ("noncommercial", "noderivatives"))
        for version in ((), ("1", "0"), ("2", "0"), ("2", "5"), ("3", "0"), ("4", "0"))
    },
    "creative commons zero": "cc0",
}
#: Sentences of notices, which put a text under a licence.
HEADERS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "licensed under the apache license": "apache",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
    **{
        f"gnu {name}general public license{published}either version {version}": f"{label}-{version}-or-later"
        for name, label in (("", "gpl"), ("lesser ", "lgpl"), ("library ", "lgpl"), ("affero ", "agpl"))
        for published in (" ", " as published by the free software foundation ")
        for version in ("2", "2 1", "3")
        if version != "2 1" or label == "lgpl"
    },
}
HEADERS = {phrase: label.replace("2 1", "2.1") for phrase, label in HEADERS.items()}
#: What a text carries after evidence of a kind, if nothing else speaks for a licence.
WEIGHTS = {"name": 0.4, "header": 0.9, "expression": 0.95}
TAG = "spdx license identifier"
# Labels and identifiers whose terms are permissive, lower-cased, without -only, -or-later or +.
PERMISSIVE = frozenset(
    """
    mit apache apache-2 bsd bsl isc cc-by cc0
    0bsd aal adsl afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 artistic-2.0 beerware blessing
    blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-2-clause-views bsd-3-clause bsd-3-clause-attribution
    bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-4-clause-uc bsd-source-code bsl-1.0 bzip2-1.0.6 cc-by-1.0 cc-by-2.0
    cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-pddc cc0-1.0 cnri-python curl ecl-1.0 ecl-2.0 efl-1.0 efl-2.0 entessa fair ftl hpnd icu
    ijg intel libpng libpng-2.0 libtiff linux-openib mit-0 mit-advertising mit-cmu mit-modern-variant mulanpsl-2.0 naumen ncsa
    ntp odc-by-1.0 ogc-1.0 openssl pddl-1.0 php-3.0 php-3.01 plexus postgresql psf-2.0 python-2.0 ruby sgi-b-2.0 smlnj ssh-openssh
    tcl tcp-wrappers unicode-3.0 unicode-dfs-2015 unicode-dfs-2016 unlicense upl-1.0 w3c w3c-19980720 w3c-20150513 wtfpl x11 xnet
    zend-2.0 zlib zlib-acknowledgement zpl-2.0 zpl-2.1
    """.split()
)
_LATER = re.compile(r"(-only|-or-later|\+)\Z")
# Families of identifiers that are not permissive; a family may be followed by a version and what is said of later ones.
FAMILIES = frozenset(
    """
    gpl lgpl agpl gfdl mpl epl cddl cpl ipl osl eupl cecill cc-by cc-by-sa cc-by-nd cc-by-nc cc-by-nc-sa cc-by-nc-nd odbl apsl rpl
    nosl npl spl sleepycat qpl lppl ofl ms-pl ms-rl busl sspl elastic artistic ngpl parity polyform-noncommercial polyform-small-business
    """.split()
)
_FAMILY = re.compile(rf"(?:{'|'.join(sorted(map(re.escape, FAMILIES), key=len, reverse=True))})(?:-v?\d+(?:\.\d+)*)?(?:-invariants|-no-invariants)?(?:-only|-or-later|\+)?")
_EXCEPTION = re.compile(r"[a-z0-9][a-z0-9.+-]*(?:exception|foss|linking|link)[a-z0-9.+-]*|(?:linux-syscall-note|openjdk-assembly-exception-1\.0|mif-exception|gcc-exception-[\d.]+)")
_REFERENCE = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")


def is_known(name: str) -> bool:
    """Whether this is an identifier: a listed one, one of a listed family, or a reference to a licence of the text's own."""
    return is_permissive(name) or bool(_FAMILY.fullmatch(name) or _REFERENCE.fullmatch(name))


_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_COLON = re.compile(rb"\s*:?")
_BINDS = {"or": 1, "and": 2, "with": 3}
_TAG_WORD = "spdx-license-identifier"


def to_postfix(expression: str, at: int = 0) -> list[str] | None:
    """The longest well-formed start of an expression in postfix form, lower-cased; None if there is none.

    The expression begins at a place of a text and ends at the first token that does not fit, or with the line.
    """
    output: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] | None = None  # how much of the output, and what follows it
    depth, last = 0, ""
    while m := _TOKEN.match(expression, at):
        token = m[1].lower().rstrip(".:") or "."
        at = m.end()
        operand = last in ("", "(", *_BINDS)  # an operand is due
        if token == _TAG_WORD:
            break
        if token == "(":
            if not operand or last == "with":
                break
            stack.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            while (top := stack.pop()) != "(":
                output.append(top)
            depth -= 1
        elif token in _BINDS:
            if operand or token == "with" and (last == ")" or stack[-1:] == ["with"]):
                break
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                output.append(stack.pop())
            stack.append(token)
        else:
            if not operand:
                break
            output.append(token)
        last = token
        if not depth and token not in _BINDS:
            best = len(output), stack[::-1]
    return None if best is None else output[: best[0]] + best[1]


def is_permissive(name: str) -> bool:
    return _LATER.sub("", name) in PERMISSIVE


def evaluate(postfix: list[str]) -> tuple[set[str], bool] | None:
    """The licences an expression names, and whether it can be used under permissive terms; None if it names anything unknown."""
    stack: list[tuple[set[str], bool]] = []
    for k, token in enumerate(postfix):
        if token not in _BINDS:
            if not is_known(token) and not (_EXCEPTION.fullmatch(token) and postfix[k + 1 : k + 2] == ["with"]):
                return None
            stack.append(({token}, is_permissive(token)))
            continue
        (right, right_ok), (left, left_ok) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(({f"{x} with {y}" for x in left for y in right}, left_ok))
            continue
        small, large = sorted((left, right), key=len)
        large |= small
        stack.append((large, left_ok and right_ok if token == "and" else left_ok or right_ok))
    return stack[0]


class Scanner:
    def __init__(self, base: dict[str, str] | None = None, more: dict[str, str] | None = None):
        import ahocorasick

        base, more = BASE_PHRASES if base is None else base, {**NAMES, **HEADERS} if more is None else more
        self.automaton = ahocorasick.Automaton()
        for phrase, label in {**more, **base}.items():
            self.automaton.add_word(f" {phrase} ", (phrase, label, phrase in base))
        self.automaton.add_word(f" {TAG} ", (TAG, None, False))
        self.automaton.make_automaton()

    def __call__(self, text: bytes) -> dict:
        words = text.translate(_TO_WORDS).split()
        flat = f" {b' '.join(words).decode('latin-1')} "
        found, tags, starts = [], [], None
        for end, (phrase, label, is_base) in self.automaton.iter(flat):
            if starts is None:
                starts = list(accumulate((len(w) + 1 for w in words), initial=1))
            word = bisect_left(starts, end - len(phrase))
            size = phrase.count(" ") + 1
            if label is None:
                tags.append(word + size)
            else:
                found.append((word, -size, phrase, label, is_base))
        places, labels, phrases, verdicts, expressions, upto = [], set(), set(), [], [], 0
        for word, size, phrase, label, is_base in sorted(found):
            if not is_base and word - size <= upto:
                continue  # inside a longer place
            upto = max(upto, word - size)
            places.append((label, word, is_base))
            labels.add(label)
            phrases.add(phrase)
            verdicts.append(is_permissive(label))
        if tags:
            spans = [m.end() for m in _WORD.finditer(text.translate(LOWER))]
            whole = text.decode("latin-1")
            for w in tags:
                postfix = to_postfix(whole, _COLON.match(text, spans[w - 1]).end())
                if postfix and (meaning := evaluate(postfix)):
                    named, allowed = meaning
                    labels |= named
                    verdicts.append(allowed)
                    expressions.append(" ".join(postfix))
        base = [w for _, w, b in places if b]
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(base, default=None),
            "last_word": max(base, default=None),
            "base_labels": sorted({x for x, _, b in places if b}),
            "labels": sorted(labels),
            "expressions": expressions,
            "permissive": all(verdicts) if verdicts else None,
            "score": 1 - prod([1 - WEIGHTS["header" if p in HEADERS else "name"] for p in sorted(phrases)] + [1 - WEIGHTS["expression"]] * len(expressions)),
        }


_RESULT = pa.schema(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_()), ("score", pa.float64())]
)


def license_scan(docs: DataFrame, base: dict[str, str] | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """One row for each document: doc_id and what ``Scanner`` finds. Extra columns are not read."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(base, more)
        for batch, texts in batches(stream, 4 << 20):
            found = [scan(t) for t in texts]
            columns = [pa.array([x[f.name] for x in found], f.type) for f in _RESULT]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", *_RESULT.names])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, expressions array<string>, permissive boolean, score double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
