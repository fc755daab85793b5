"""Licence scans: ordered signature rules behind a keyword filter; contained detections give way."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.common import in_chunks, plain, text_of

# A word: digits, letters a to z, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same, in texts that are not lower-cased yet.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Fixed phrases and their labels. Every place where the words of one stand one after the other counts.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Names of licences in words: (label, keyword that any match holds as part of one word, pattern over words with single spaces).
NAMES = (
    ("apache-1.0", "apache", r"apache (?:software )?license (?:version |v ?)?1 0"),
    ("apache-1.1", "apache", r"apache (?:software )?license (?:version |v ?)?1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?2(?: 0)?|asl 2 0 apache"),
    ("mit", "mit", r"(?:the )?mit x11|expat mit|mit license"),
    ("mit-0", "mit", r"mit no attribution(?: license)?|mit 0"),
    ("x11", "x11", r"x11 license|x consortium license x11"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)(?: license)?"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: license)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)(?: license)?"),
    ("gpl-1.0", "general", r"(?:gnu )?general public license (?:version |v ?)?1(?: 0)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public license (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public license (?:version |v ?)?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: v| version)? ?2(?: 0)?(?: only| or later)?|gplv2"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: v| version)? ?3(?: 0)?(?: only| or later)?|gplv3"),
    ("lgpl-2.0", "general", r"(?:gnu )?(?:library|lesser) general public license (?:version |v ?)?2(?: 0)?"),
    ("lgpl-2.1", "general", r"(?:gnu )?lesser general public license (?:version |v ?)?2 1"),
    ("lgpl-3.0", "general", r"(?:gnu )?lesser general public license (?:version |v ?)?3(?: 0)?"),
    ("lgpl", "general", r"(?:gnu )?(?:library|lesser) general public license"),
    ("lgpl-2.1", "lgpl", r"lgpl(?: v| version)? ?2 1(?: only| or later)?"),
    ("lgpl-3.0", "lgpl", r"lgpl(?: v| version)? ?3(?: 0)?(?: only| or later)?|lgplv3"),
    ("agpl-3.0", "general", r"(?:gnu )?affero general public license(?: version| v)? 3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    ("agpl-3.0", "agpl", r"agpl(?: v| version)? ?3(?: 0)?(?: only| or later)?|agplv3"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license(?: (?:version |v ?)?1 [123])?"),
    ("mpl-1.0", "mozilla", r"mozilla public license (?:version |v ?)?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license (?:version |v ?)?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license (?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("epl-1.0", "eclipse", r"eclipse public license (?:version |v ?)?1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license (?:version |v ?)?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    ("edl-1.0", "eclipse", r"eclipse distribution license(?: (?:version |v ?)?1 0)?"),
    ("cddl-1.0", "development", r"common development and distribution license (?:version |v ?)?1 0"),
    ("cddl-1.1", "development", r"common development and distribution license (?:version |v ?)?1 1"),
    ("cddl", "development", r"common development and distribution license"),
    ("cpl-1.0", "public", r"common public license(?: (?:version |v ?)?1 0)?"),
    ("ipl-1.0", "ibm", r"ibm public license(?: (?:version |v ?)?1 0)?"),
    ("eupl-1.1", "european", r"european union public licen[cs]e (?:version |v ?)?1 1"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: (?:version |v ?)?1 2)?"),
    ("cecill-2.1", "cecill", r"cecill(?: free software license agreement)?(?: (?:version |v ?)?2 1)?"),
    ("cecill-b", "cecill", r"cecill b"),
    ("cecill-c", "cecill", r"cecill c"),
    ("isc", "isc", r"isc license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license|zlib libpng"),
    ("libpng", "libpng", r"libpng license"),
    ("bsl-1.0", "boost", r"boost software license(?: (?:version |v ?)?1 0)?"),
    ("busl-1.1", "business", r"business source license(?: (?:version |v ?)?1 1)?"),
    ("sspl-1.0", "server", r"server side public license(?: (?:version |v ?)?1)?"),
    ("elastic-2.0", "elastic", r"elastic license(?: (?:version |v ?)?2(?: 0)?)?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("python-2.0", "python", r"python (?:software foundation )?license(?: (?:version |v ?)?2(?: 0)?)?"),
    ("php-3.01", "php", r"php license(?: (?:version |v ?)?3 01)?"),
    ("ruby", "ruby", r"ruby license"),
    ("artistic-1.0", "artistic", r"artistic license(?: (?:version |v ?)?1 0)?"),
    ("artistic-2.0", "artistic", r"artistic license (?:version |v ?)?2(?: 0)?"),
    ("afl-3.0", "academic", r"academic free license(?: (?:version |v ?)?3 0)?"),
    ("osl-3.0", "open", r"open software license(?: (?:version |v ?)?3 0)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source license"),
    ("upl-1.0", "universal", r"universal permissive license(?: (?:version |v ?)?1 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense(?: org)?"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl-1.1", "font", r"(?:sil )?open font license(?: (?:version |v ?)?1 1)?"),
    ("openssl", "openssl", r"openssl license"),
    ("beerware", "beer", r"(?:the )?beer ?ware license"),
    ("vim", "vim", r"vim license"),
    ("json", "json", r"json license"),
    ("qpl-1.0", "public", r"q public license(?: (?:version |v ?)?1 0)?"),
    ("lppl-1.3c", "latex", r"latex project public license(?: (?:version |v ?)?1 3c?)?"),
    ("odbl-1.0", "odbl", r"odbl(?: 1 0)?"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: (?:version |v ?)?1 0)?"),
    ("odc-by-1.0", "attribution", r"open data commons attribution license(?: (?:version |v ?)?1 0)?"),
    ("pddl-1.0", "domain", r"(?:open data commons )?public domain dedication and license"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-1.0", "cc", r"cc by 1 0"),
    ("cc-by-2.0", "cc", r"cc by 2 0"),
    ("cc-by-2.5", "cc", r"cc by 2 5"),
    ("cc-by-3.0", "cc", r"cc by 3 0"),
    ("cc-by-4.0", "cc", r"cc by 4 0"),
    ("cc-by-sa-2.0", "cc", r"cc by sa 2 [05]"),
    ("cc-by-sa-3.0", "cc", r"cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc", r"cc by sa 4 0"),
    ("cc-by-nc-2.0", "cc", r"cc by nc 2 [05]"),
    ("cc-by-nc-3.0", "cc", r"cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc", r"cc by nc 4 0"),
    ("cc-by-nd-3.0", "cc", r"cc by nd 3 0"),
    ("cc-by-nd-4.0", "cc", r"cc by nd 4 0"),
    ("cc-by-nc-sa-3.0", "cc", r"cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-3.0", "cc", r"cc by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", "cc", r"cc by nc nd 4 0"),
    ("cc-by-sa-4.0", "commons", r"creative commons attribution share ?alike(?: 4 0)?(?: international)?"),
    ("cc-by-nc-4.0", "commons", r"creative commons attribution non ?commercial(?: 4 0)?(?: international)?"),
    ("cc-by-4.0", "commons", r"creative commons attribution(?: 4 0)?(?: international)?"),
    ("public-domain", "domain", r"(?:in|into|to) the public domain|public domain dedication"),
    ("proprietary", "rights", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential|confidential and proprietary"),
)

# Short identifiers of licences as words, for labels whose identifier is not the label itself.
IDENTIFIERS = {
    "gfdl": r"gfdl(?: 1 [123])?(?: only| or later)?",
    "cc-by-sa-2.0": "cc by sa 2 [05]",
    "cc-by-nc-2.0": "cc by nc 2 [05]",
    "lppl-1.3c": "lppl 1 3[ac]",
    **{label: label.replace("-", " ").replace(".", " ") + "(?: only| or later)?" for label in ("gpl-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0")},
}
# Labels that are no identifiers, and identifiers that are plain words or names of programs, which count in tags only.
NO_IDENTIFIERS = frozenset("public-domain proprietary edl-1.0 lgpl agpl mpl epl cddl".split())
IN_TAGS_ONLY = frozenset("ruby vim json beerware openssl postgresql libpng x11".split())

# Exceptions that follow a licence and WITH in a tag.
EXCEPTIONS = tuple(
    "389-exception asterisk-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception "
    "classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 linux-syscall-note llvm-exception "
    "ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 qt-gpl-exception-1.0 swift-exception u-boot-exception-2.0 "
    "universal-foss-exception-1.0 wxwindows-exception-3.1".split()
)

# Sentences of licence texts: (label, keyword, pattern).
SENTENCES = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "copy", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", r"neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("unlicense", "encumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "want", r"do what the fuck you want to public license"),
    ("bsl-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license"),
)

# How texts speak of a licence by its name: (form, priority, confidence, pattern around the name). Higher priorities win.
FORMS = (
    ("name", 2, 0.6, r"{name}"),
    ("licensed", 3, 0.9, r"(?:dual )?(?:licen[cs]ed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?{name}(?: licen[cs]e)?"),
    ("tag", 4, 1.0, r"spdx license identifier {name}"),
)
BASE_PRIORITY, BASE_CONFIDENCE = 1, 0.5
SENTENCE_PRIORITY, SENTENCE_CONFIDENCE = 3, 0.95


@dataclass(frozen=True)
class Rule:
    """A signature: its matches take ``label``, if their ``keyword`` is in the text at all."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float
    base: bool = False
    also: str = ""  # a second keyword, if any
    member: str = ""  # of a tag: the pattern of its identifier, which may be one of several joined by OR, AND or WITH


def _words(label: str) -> str:
    return label.replace("-", " ").replace(".", " ")


def identifiers() -> dict[str, str]:
    """Patterns of the identifiers, by label."""
    labels = dict.fromkeys(label for label, _, _ in NAMES)
    return {x: IDENTIFIERS.get(x, _words(x)) for x in labels if x not in NO_IDENTIFIERS}


def _both_spellings(pattern: str) -> str:
    return re.sub(r"\blicense\b", "licen[cs]e", pattern)


def rules() -> tuple[Rule, ...]:
    """All rules in their order: tags, sentences and phrases, names, base phrases; of equal rules the earlier one wins."""
    found = [
        Rule(label, keyword, around.replace("{name}", f"(?:{_both_spellings(name)})"), priority, confidence)
        for form, priority, confidence, around in FORMS
        for label, keyword, name in NAMES
    ]
    for form, priority, confidence, around in FORMS:
        for label, name in identifiers().items():
            first = name.split()[0].split("(")[0]
            if form == "tag":
                found.append(Rule(label, "spdx", around.replace("{name}", f"(?:{name})"), priority, confidence, member=name))
            elif form == "licensed" and label not in IN_TAGS_ONLY:
                found.append(Rule(label, first, around.replace("{name}", f"(?:{name})"), priority, confidence, also="under"))
    _, priority, confidence, around = FORMS[-1]
    for label in EXCEPTIONS:
        name = _words(label)
        found.append(Rule(label, "spdx", around.replace("{name}", name), priority, confidence, member=name))
    found += [Rule(label, keyword, _both_spellings(sentence), SENTENCE_PRIORITY, SENTENCE_CONFIDENCE) for label, keyword, sentence in SENTENCES]
    found += [Rule(label, phrase.split()[0], phrase, BASE_PRIORITY, BASE_CONFIDENCE, True) for phrase, label in BASE]
    return tuple(sorted(found, key=lambda rule: -rule.priority))


def keywords(rules_: tuple[Rule, ...]) -> list[str]:
    return sorted({rule.keyword for rule in rules_})


@dataclass(frozen=True)
class Detection:
    first: int  # words from 0
    last: int
    rule: int


class Scanner:
    """Finds the detections of a text that no other detection of the same or a higher priority contains."""

    def __init__(self, rules_: tuple[Rule, ...]):
        self.rules = rules_
        # a match begins and ends with whole words; looking ahead finds places that overlap
        self.patterns = [re.compile(rf"(?<![^ ])(?=({rule.pattern})(?![^ ]))") for rule in rules_]
        self.gated: dict[tuple[str, str], list[int]] = {}  # the rules behind the same keywords
        for number, rule in enumerate(rules_):
            self.gated.setdefault((rule.keyword, rule.also), []).append(number)
        self.word = re.compile(WORD)
        self.members = [number for number, rule in enumerate(rules_) if rule.member]
        one = "|".join(rules_[number].member for number in self.members)
        self.expression = re.compile(rf"(?<![^ ])spdx license identifier ((?:{one})(?: (?:or|and|with) (?:{one}))+)(?![^ ])")
        joined = "|".join(f"({rules_[number].member})" for number in self.members)
        self.member = re.compile(rf"(?<![^ ])(?:{joined})(?= (?:or|and|with) |$)")

    def detections(self, text: str) -> tuple[list[Detection], list[Detection]]:
        """All detections, and those that stand; base phrases always stand."""
        lowered = text.translate(_LOWER)
        words = self.word.findall(lowered)
        line = " ".join(words)
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1].tolist()
        found = []

        def add(begin: int, end: int, number: int) -> None:
            found.append(Detection(bisect.bisect_left(begins, begin), bisect.bisect_left(begins, end) - 1, number))

        for (keyword, also), numbers in self.gated.items():
            if keyword in line and also in line:
                for number in numbers:
                    for match in self.patterns[number].finditer(line):
                        add(match.start(1), match.end(1), number)
        if self.members and "spdx" in line:
            for begin, end, number in self._joined(line):
                add(begin, end, number)
        return found, self._standing(found)

    def _joined(self, line: str) -> Iterator[tuple[int, int, int]]:
        """Identifiers of tags that join several by OR, AND or WITH: where they stand, and the rule of a tag of their own."""
        for tag in self.expression.finditer(line):
            for part in self.member.finditer(line, tag.start(1), tag.end(1)):
                yield part.start(), part.end(), self.members[part.lastindex - 1]

    def _standing(self, found: list[Detection]) -> list[Detection]:
        """From left to right, the longer and stronger first: what an earlier one of its strength contains gives way."""
        standing = []
        reached: dict[int, int] = {}  # the last word of what stands, by priority
        for d in sorted(found, key=lambda d: (d.first, -d.last, -self.rules[d.rule].priority, d.rule)):
            rule = self.rules[d.rule]
            contained = any(last >= d.last for priority, last in reached.items() if priority >= rule.priority)
            if not contained or rule.base:
                standing.append(d)
            if not contained:
                reached[rule.priority] = max(reached.get(rule.priority, -1), d.last)
        return standing


_LOWER = {c: c + 32 for c in range(65, 91)}


def scan(
    docs: DataFrame, rules_: tuple[Rule, ...] | None = None, id_column: str = "doc_id", text_column: str = "text",
    details: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: (id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest first
    words (NULL if there are none). ``base_labels`` and ``labels`` (also those of the other rules that stand) are distinct,
    sorted and joined by commas. ``score`` is the highest confidence of what stands, 0 if nothing does. ``details`` adds
    ``spans``: (first, last, label) of what stands, in order.

    Texts are looked at whole. Spark counts the words and looks for the keywords; only texts with one of them are sent to
    Python, where a rule runs if its own keyword is there. Nothing is shuffled. NULL texts are empty: no words, no labels
    (empty strings). Repeated rows get equal answers; other columns are not looked at; an empty table gives no rows.
    """
    rules_ = rules_ if rules_ is not None else rules()
    text = text_of(text_column)
    lowered = F.lower(text)
    gate = F.lit(False)
    alone = {rule.keyword for rule in rules_ if not rule.also}
    for keyword in sorted(alone):
        gate = gate | F.contains(lowered, F.lit(keyword))
    for also in sorted({rule.also for rule in rules_} - {""}):
        either = F.lit(False)
        for keyword in sorted({rule.keyword for rule in rules_ if rule.also == also} - alone):
            either = either | F.contains(lowered, F.lit(keyword))
        gate = gate | (F.contains(lowered, F.lit(also)) & either)
    rows = docs.select(
        plain(id_column).alias("id"),
        F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"),
        F.when(gate, text).alias("_text"),
    )
    long, string = T.LongType(), T.StringType()
    fields = {"n_base": long, "first_word": long, "last_word": long, "base_labels": string, "labels": string, "score": T.DoubleType()}
    if details:
        span = T.StructType().add("first", T.IntegerType()).add("last", T.IntegerType()).add("label", string)
        fields["spans"] = T.ArrayType(span)
    schema = rows.select("id", "n_words").schema
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules_)
        for batch in in_chunks(batches, "_text"):
            columns: dict[str, list] = {name: [] for name in fields}
            for text_ in batch.column("_text").to_pylist():
                standing = scanner.detections(text_)[1] if text_ else []
                base = [d for d in standing if rules_[d.rule].base]
                firsts = [d.first for d in base]
                columns["n_base"].append(len(base))
                columns["first_word"].append(min(firsts, default=None))
                columns["last_word"].append(max(firsts, default=None))
                columns["base_labels"].append(",".join(sorted({rules_[d.rule].label for d in base})))
                columns["labels"].append(",".join(sorted({rules_[d.rule].label for d in standing})))
                columns["score"].append(max((rules_[d.rule].confidence for d in standing), default=0.0))
                if details:
                    columns["spans"].append([{"first": d.first, "last": d.last, "label": rules_[d.rule].label} for d in standing])
            arrays = [pa.array(values, arrow.field(name).type) for name, values in columns.items()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), *arrays], ["id", "n_words", *columns])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)
