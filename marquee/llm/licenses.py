"""License scan: ordered signature rules behind a keyword gate, overlaps resolved by containment."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from marquee.llm.common import alnum_words, lower_ascii, texts, with_columns

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Priorities: a whole license text or header beats a name with version, which beats a bare name, which beats a hint.
TEXT, NAMED, BARE, HINT = 3, 2, 1, 0


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: bytes  # must occur in the folded text before the pattern is tried
    pattern: re.Pattern
    priority: int
    score: float


S = r"(?:[\s,;:*#/|>-]{1,8})"  # what may stand between two words of a signature
_ENDS = r"(?<![a-z0-9_.-])", r"(?![a-z0-9_])"
_BLANKED = bytes(32 if b in b" \t\n\r\f\v,;:*#/|>-" else b for b in range(256))


def folded(lowered: bytes) -> bytes:
    """Each run of what may stand between two words as one blank: what a pattern matches holds its keyword."""
    return b" ".join(lowered.translate(_BLANKED).split())


def _signature(words: str) -> str:
    return _ENDS[0] + words.replace(" ", S) + _ENDS[1]


def _numbered(version: str) -> str:
    return version.replace(".", r"\.") + (r"(?:\.0)?" if "." not in version else "")


def rules() -> list[Rule]:
    """Several hundred rules: written signatures, and families of names written out per version."""
    out: list[Rule] = []

    def add(label: str, keyword: str, words: str, priority: int = NAMED, score: float = 0.9):
        out.append(Rule(f"{label}_{len(out)}", label, folded(keyword.encode()), re.compile(_signature(words).encode()), priority, score))

    # GNU licenses: short names, long names, identifiers, addresses
    for short, title, versions in (("gpl", "general public", "1 2 3"), ("lgpl", "lesser general public", "2.1 3"),
                                   ("lgpl", "library general public", "2"), ("agpl", "affero general public", "1 3"),
                                   ("gfdl", "free documentation", "1.1 1.2 1.3")):
        for v in versions.split():
            n, label = _numbered(v), f"{short}-{v}"
            add(label, short, rf"(?:gnu )?{short} ?-? ?v?{n}(?:\+|-only|-or-later)?")
            add(label, short, rf"{short} (?:license )?version {n}")
            add(label, title, rf"(?:gnu )?{title} license v{n}")
            add(label, title, rf"(?:gnu )?{title} license (?:as published by the free software foundation )?(?:either )?version {n}(?: of the license)?", TEXT, 1.0)
            add(label, "gnu.org", rf"gnu\.org/licenses/(?:old-licenses/)?{short}-{n}(?:\.html|\.txt)?", NAMED, 0.95)
            add(label, "spdx", rf"spdx-license-identifier: {short}-{n}(?:\+|-only|-or-later)?", TEXT, 1.0)
        add(short, title, rf"gnu {title} license", BARE, 0.8)
        add(short, short, rf"(?:gnu )?{short} license", BARE, 0.7)
    add("gpl", "general public", "gnu general public license", BARE, 0.8)

    # Creative Commons: six kinds, five versions
    kinds = {"by": "attribution", "by-sa": "attribution-share-?alike", "by-nc": "attribution-non-?commercial",
             "by-nd": "attribution-no-?deriv(?:ative)?s?", "by-nc-sa": "attribution-non-?commercial-share-?alike",
             "by-nc-nd": "attribution-non-?commercial-no-?deriv(?:ative)?s?"}
    for kind, title in kinds.items():
        mark, title = kind.replace("-", " "), title.replace("-s", " s").replace("-n", " n")
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            n, label = _numbered(v), f"cc-{kind}-{v}"
            add(label, "cc", rf"cc {mark} {n}")
            add(label, "creative commons", rf"creative commons {title} {n}", TEXT, 1.0)
            add(label, "creativecommons.org", rf"creativecommons\.org/licenses/{kind}/{n}", TEXT, 1.0)
        add(f"cc-{kind}", "cc", rf"cc {mark}", BARE, 0.8)
        add(f"cc-{kind}", "creative commons", rf"creative commons {title}(?: license)?", BARE, 0.85)
    add("cc0-1.0", "cc0", r"cc0(?: 1\.0)?")
    add("cc0-1.0", "publicdomain", r"creativecommons\.org/publicdomain/zero/1\.0", TEXT, 1.0)

    # families with a name, versions and an identifier
    for label, title, key, versions in (
            ("apache", "apache(?: software)? license", "apache", "1.0 1.1 2.0"), ("mpl", "mozilla public license", "mozilla", "1.0 1.1 2.0"),
            ("epl", "eclipse public license", "eclipse", "1.0 2.0"), ("cddl", "common development and distribution license", "common development", "1.0 1.1"),
            ("artistic", "artistic license", "artistic", "1.0 2.0"), ("afl", "academic free license", "academic free", "1.1 1.2 2.0 2.1 3.0"),
            ("osl", "open software license", "open software", "1.0 2.0 2.1 3.0"), ("eupl", "european union public licen[cs]e", "european union", "1.0 1.1 1.2"),
            ("bsl", "boost software license", "boost", "1.0"), ("busl", "business source license", "business source", "1.1"),
            ("ofl", "sil open font license", "open font", "1.0 1.1"), ("cpl", "common public license", "common public", "1.0"),
            ("ecl", "educational community license", "educational community", "1.0 2.0"), ("lppl", r"latex project public license", "latex project", "1.0 1.1 1.2 1.3"),
            ("php", "php license", "php license", "2.02 3.0 3.01"), ("zpl", "zope public license", "zope", "1.1 2.0 2.1"),
            ("odbl", "open database license", "open database", "1.0"), ("ogl", "open government licen[cs]e", "open government", "1.0 2.0 3.0"),
            ("ms-pl", "microsoft public license", "microsoft public", "1.0"), ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal", "1.0"),
            ("rpl", "reciprocal public license", "reciprocal public", "1.1 1.5"), ("qpl", "q public license", "q public", "1.0"),
            ("cecill", "cecill", "cecill", "1.0 1.1 2.0 2.1"), ("mulan", "mulan(?: psl| permissive software license)", "mulan", "1 2"),
            ("upl", "universal permissive license", "universal permissive", "1.0"), ("sspl", "server side public license", "server side", "1")):
        for v in versions.split():
            n = _numbered(v)
            add(f"{label}-{v}", key, rf"{title} (?:\({label}\) )?(?:version |v\.? ?)?{n}", TEXT, 1.0)
            add(f"{label}-{v}", label, rf"{label} (?:version |v\.? ?)?{n}")
            add(f"{label}-{v}", "spdx", rf"spdx-license-identifier: {label}-{n}", TEXT, 1.0)
        add(label, key, title, BARE, 0.8)
    add("apache-2.0", "apache.org", r"apache\.org/licenses/license-2\.0", TEXT, 1.0)

    # BSD family and short permissive texts
    for n, word in (("0", "zero"), ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four")):
        add(f"bsd-{n}-clause", "clause", rf"(?:{n}|{word}) clause bsd(?: license)?")
        add(f"bsd-{n}-clause", "bsd", rf"bsd (?:{n}|{word}) clause(?: license)?")
        add(f"bsd-{n}-clause", "spdx", rf"spdx-license-identifier: bsd-{n}-clause", TEXT, 1.0)
    for label, key, words, priority, score in (
            ("bsd-2-clause", "simplified bsd", "simplified bsd(?: license)?", NAMED, 0.9),
            ("bsd-3-clause", "bsd", "(?:new|modified|revised) bsd(?: license)?", NAMED, 0.9),
            ("bsd", "bsd", "bsd(?:-style)? licen[cs]e", BARE, 0.8),
            ("bsd", "redistribution and use", "redistribution and use in source and binary forms", TEXT, 0.95),
            ("mit", "mit license", "(?:the )?mit license", BARE, 0.85),
            ("mit", "mit", "mit licensed", BARE, 0.8),
            ("mit", "opensource.org", r"opensource\.org/licenses/mit", NAMED, 0.95),
            ("mit", "spdx", "spdx-license-identifier: mit", TEXT, 1.0),
            ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", TEXT, 1.0),
            ("mit-0", "mit", "mit no attribution", NAMED, 0.9),
            ("isc", "isc license", "isc license", BARE, 0.85),
            ("isc", "permission to use", "permission to use copy modify and/or distribute this software for any purpose", TEXT, 1.0),
            ("zlib", "zlib", "zlib(?:/libpng)? license", BARE, 0.85),
            ("zlib", "provided 'as-is'", "this software is provided 'as-is' without any express or implied warranty", TEXT, 0.95),
            ("unlicense", "unlicense", "(?:the )?unlicense", BARE, 0.85),
            ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", TEXT, 1.0),
            ("wtfpl", "wtfpl", "wtfpl", BARE, 0.9),
            ("x11", "x11 license", "x11 license", BARE, 0.85),
            ("ncsa", "ncsa", "(?:university of illinois/)?ncsa open source license", NAMED, 0.95),
            ("psf-2.0", "python software foundation", "python software foundation license(?: version 2)?", NAMED, 0.95),
            ("ruby", "ruby license", "ruby license", BARE, 0.85),
            ("openssl", "openssl license", "openssl license", BARE, 0.85),
            ("postgresql", "postgresql", "postgresql licen[cs]e", BARE, 0.9),
            ("vim", "vim license", "vim license", BARE, 0.9),
            ("w3c", "w3c", "w3c software (?:notice and )?license", NAMED, 0.9),
            ("json", "good, not evil", "the software shall be used for good not evil", TEXT, 1.0),
            ("beerware", "beer-ware", "the beer-ware license", NAMED, 0.95),
            ("curl", "curl license", "curl license", BARE, 0.85),
            ("imagemagick", "imagemagick license", "imagemagick license", BARE, 0.9),
            ("sleepycat", "sleepycat", "sleepycat license", BARE, 0.9),
            ("pddl-1.0", "public domain dedication", "(?:open data commons )?public domain dedication and license", NAMED, 0.95),
            ("public-domain", "public domain", "(?:released|dedicated|placed)(?: in)?(?:to)? the public domain", HINT, 0.6),
            ("public-domain", "public domain", "(?:is|are) in the public domain", HINT, 0.6),
            ("proprietary", "all rights reserved", "all rights reserved", HINT, 0.5),
            ("proprietary", "proprietary and confidential", "proprietary and confidential", HINT, 0.6),
            ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited", TEXT, 0.9),
            ("free-unspecified", "licensed under", "licensed under (?:an? )?(?:free|open) (?:source )?licen[cs]e", HINT, 0.4)):
        add(label, key, words, priority, score)
    return out


def detect(lowered: bytes, table: list[Rule], keywords: list[bytes]) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) by start.

    A detection inside another of at least its priority is suppressed; of equal spans the
    higher priority, then the earlier rule stays.
    """
    text = folded(lowered)
    present = {k for k in keywords if k in text}
    if not present:
        return []
    found = [(m.start(), m.end(), rule, place) for place, rule in enumerate(table) if rule.keyword in present
             for m in rule.pattern.finditer(lowered)]
    found.sort(key=lambda d: (d[0], -d[1], -d[2].priority, d[3]))
    reach = [-1] * (TEXT + 1)  # furthest end so far among detections of each priority
    kept = []
    for start, end, rule, _ in found:
        if max(reach[rule.priority:]) < end:
            kept.append((start, end, rule))
        reach[rule.priority] = max(reach[rule.priority], end)
    return kept


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out, joined = [], b" " + b" ".join(words) + b" "
    for phrase, label in BASE.items():
        needle = b" " + phrase.encode() + b" "
        at, counted, place = joined.find(needle), 0, 0
        while at >= 0:
            place += joined.count(b" ", counted, at)
            counted = at
            out.append((place, label))
            at = joined.find(needle, at + 1)
    return out


OUTPUTS = {"n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string",
           "labels": "string", "score": "double",
           "detections": "array<struct<start:bigint,end:bigint,rule:string,label:string,priority:int,score:double>>"}


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its base phrases, labels, best score and the kept detections (byte spans of the text).

    Rules run over the whole text, lower-cased for A-Z, and only if their keyword occurs, with
    any separators between its words. Null
    and empty texts have no words, empty labels and score 0. Repeated rows get the same result,
    an empty table gives no rows, and columns with a result's name are replaced.
    """
    table = rules()
    keywords = sorted({r.keyword for r in table})

    def run(batch):
        out = {name: [] for name in OUTPUTS}
        for t in texts(batch, text):
            words = alnum_words(t)
            lowered = lower_ascii(t)
            places = base_places(words)
            kept = detect(lowered, table, keywords)
            base = {label for _, label in places}
            at = [p for p, _ in places]
            values = (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                      ",".join(sorted(base | {r.label for _, _, r in kept})),
                      max([r.score for _, _, r in kept] + [0.8] * bool(base), default=0.0),
                      [{"start": a, "end": b, "rule": r.name, "label": r.label, "priority": r.priority, "score": r.score} for a, b, r in kept])
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    return with_columns(docs, OUTPUTS, run)
