"""License scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

Rules are hand-written regular expressions over the words of a text (lower-cased A-Z, joined by single
spaces), so they work across line breaks and punctuation. A rule has a label, a priority and a keyword that every
match of its pattern holds as whole words; it runs on a text only if the text holds its keyword. A detection is dropped if it lies inside a kept one of higher
priority, or of the same priority and greater length; equal intervals go to the rule written first.

``BASE`` phrases are plain word sequences that always count: each place where the words stand consecutively.

Defined results: null and empty texts have no words and no label, score 0; repeated rows get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import alnum_words, bounded_batches

#: phrase -> label, fixed by the contract of the query
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern


# Each family: label, keyword, and its patterns by kind. {v} stands for a version, written as words ("2 0").
# Kinds by priority: 4 a grant or header sentence, 3 name with version, 2 an SPDX tag or short id, 1 a bare name.
_V = r"(?:v|version |ver )?"
_FAMILIES: list[tuple[str, str, list[tuple[int, str]]]] = [
    ("apache-2.0", "apache", [
        (4, r"licensed under the apache license version 2(?: 0)?"), (4, r"apache license version 2 0 january 2004"),
        (3, rf"apache (?:software )?licen[cs]e {_V}2(?: 0)?"), (2, r"spdx license identifier apache 2 0"),
        (2, r"apache 2 0 licen[cs]e"), (1, r"www apache org licenses license 2 0")]),
    ("apache-1.1", "apache", [(3, rf"apache (?:software )?licen[cs]e {_V}1 1"), (2, r"spdx license identifier apache 1 1")]),
    ("apache-1.0", "apache", [(3, rf"apache (?:software )?licen[cs]e {_V}1 0"), (2, r"spdx license identifier apache 1 0")]),
    ("mit", "mit", [
        (4, r"released under the mit license"), (4, r"licensed under the mit license"),
        (3, r"the mit license mit"), (2, r"spdx license identifier mit(?! 0)"), (1, r"mit licensed"),
        (1, r"opensource org licenses mit")]),
    ("mit", "permission", [
        (4, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            r"documentation files")]),
    ("mit-0", "mit 0", [(2, r"spdx license identifier mit 0"), (1, r"mit 0 license")]),
    ("isc", "isc", [(3, r"isc licen[cs]e"), (2, r"spdx license identifier isc")]),
    ("isc", "permission", [
        (4, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            r"granted")]),
    ("0bsd", "0bsd", [(2, r"spdx license identifier 0bsd"), (1, r"0bsd licen[cs]e")]),
    ("bsd", "bsd", [(1, r"bsd licen[cs]e"), (1, r"bsd style licen[cs]e")]),
    ("bsd", "berkeley", [(1, r"berkeley software distribution licen[cs]e")]),
    ("bsd-2-clause", "bsd", [
        (3, r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd) licen[cs]e"),
        (2, r"spdx license identifier bsd 2 clause")]),
    ("bsd-2-clause", "freebsd", [(3, r"freebsd licen[cs]e")]),
    ("bsd-3-clause", "bsd", [
        (3, r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e"),
        (2, r"spdx license identifier bsd 3 clause")]),
    ("bsd-4-clause", "bsd", [
        (3, r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd) licen[cs]e"),
        (2, r"spdx license identifier bsd 4 clause")]),
    ("bsd", "redistribution", [
        (4, r"redistribution and use in source and binary forms with or without modification are permitted")]),
    ("bsd-3-clause", "neither the", [
        (4, r"neither the names? of (?:\S+ ){1,8}nor the names of (?:its|their) contributors may be used to endorse or "
            r"promote products")]),
    ("mpl-2.0", "mozilla", [
        (4, r"subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
        (3, rf"mozilla public licen[cs]e {_V}2(?: 0)?")]),
    ("mpl-2.0", "mpl 2 0", [(2, r"spdx license identifier mpl 2 0")]),
    ("mpl-1.1", "mozilla", [(3, rf"mozilla public licen[cs]e {_V}1 1")]),
    ("mpl-1.1", "mpl 1 1", [(2, r"spdx license identifier mpl 1 1")]),
    ("mpl-1.0", "mozilla", [(3, rf"mozilla public licen[cs]e {_V}1 0")]),
    ("mpl", "mozilla", [(1, r"mozilla public licen[cs]e")]),
    ("mpl-2.0", "mpl 2", [(2, r"mpl 2 0"), (2, r"mozilla org mpl 2 0")]),
    ("epl-2.0", "eclipse", [(3, rf"eclipse public licen[cs]e {_V}2(?: 0)?"), (4, r"made available under the terms of the "
                            r"eclipse public license 2 0")]),
    ("epl-1.0", "eclipse", [(3, rf"eclipse public licen[cs]e {_V}1(?: 0)?")]),
    ("epl", "eclipse", [(1, r"eclipse public licen[cs]e")]),
    ("edl-1.0", "eclipse distribution", [(3, r"eclipse distribution licen[cs]e(?: v 1 0)?")]),
    ("cddl-1.0", "cddl", [(2, r"cddl 1 0"), (1, r"cddl")]),
    ("cddl", "common development", [(3, r"common development and distribution licen[cs]e")]),
    ("cpl-1.0", "common public", [(3, rf"common public licen[cs]e(?: {_V}1 0)?")]),
    ("cpal-1.0", "common public attribution", [(3, rf"common public attribution licen[cs]e(?: {_V}1 0)?")]),
    ("eupl-1.2", "eupl", [(2, r"eupl 1 2"), (2, r"eupl v 1 2")]),
    ("eupl-1.1", "eupl", [(2, r"eupl 1 1"), (2, r"eupl v 1 1")]),
    ("eupl", "european union public", [(3, r"european union public licen[cs]e")]),
    ("artistic-2.0", "artistic", [(3, rf"artistic licen[cs]e {_V}2(?: 0)?"), (2, r"spdx license identifier artistic 2 0")]),
    ("artistic-1.0", "artistic", [(3, rf"artistic licen[cs]e {_V}1(?: 0)?")]),
    ("artistic", "artistic", [(1, r"artistic licen[cs]e")]),
    ("artistic", "perl itself", [(4, r"under the same terms as perl itself")]),
    ("boost-1.0", "boost", [(3, rf"boost software licen[cs]e(?: {_V}1 0)?")]),
    ("boost-1.0", "bsl 1 0", [(2, r"spdx license identifier bsl 1 0")]),
    ("zlib", "zlib", [(1, r"zlib licen[cs]e"), (2, r"spdx license identifier zlib"), (1, r"zlib libpng licen[cs]e")]),
    ("zlib", "altered source", [(4, r"altered source versions must be plainly marked as such")]),
    ("libpng", "libpng", [(1, r"libpng licen[cs]e")]),
    ("unlicense", "unlicense", [(1, r"the unlicense"), (2, r"spdx license identifier unlicense"), (1, r"unlicense org")]),
    ("unlicense", "unencumbered", [(4, r"this is free and unencumbered software released into the public domain")]),
    ("public-domain", "public domain", [
        (3, r"(?:released|placed|dedicated|donated) (?:in)?to the public domain"), (1, r"is in the public domain")]),
    ("wtfpl", "wtfpl", [(1, r"wtfpl")]),
    ("wtfpl", "want to public", [(3, r"do what the f\S* you want to public licen[cs]e")]),
    ("postgresql", "postgresql", [(3, r"postgresql licen[cs]e")]),
    ("python-2.0", "python", [(3, r"python software foundation licen[cs]e(?: version 2)?")]),
    ("python-2.0", "psf", [(2, r"psf 2 0"), (1, r"psf licen[cs]e")]),
    ("ruby", "ruby", [(1, r"ruby licen[cs]e"), (4, r"under the same terms as ruby")]),
    ("php-3.01", "php", [(3, rf"php licen[cs]e {_V}3 0?1"), (1, r"php licen[cs]e")]),
    ("perl", "perl", [(1, r"perl licen[cs]e")]),
    ("openssl", "openssl", [(1, r"openssl licen[cs]e"), (4, r"this product includes software developed by the openssl project")]),
    ("curl", "curl", [(1, r"curl licen[cs]e")]),
    ("x11", "x11", [(1, r"x11 licen[cs]e")]),
    ("x11", "x consortium", [(1, r"x consortium licen[cs]e")]),
    ("ntp", "ntp", [(1, r"ntp licen[cs]e")]),
    ("ofl-1.1", "open font", [(3, rf"(?:sil )?open font licen[cs]e(?: {_V}1 1)?"), (4, r"licensed under the sil open font license")]),
    ("ofl-1.1", "ofl", [(2, r"ofl 1 1"), (1, r"scripts sil org ofl")]),
    ("bitstream-vera", "bitstream", [(1, r"bitstream vera licen[cs]e")]),
    ("ms-pl", "microsoft public", [(3, r"microsoft public licen[cs]e(?: ms pl)?")]),
    ("ms-rl", "microsoft reciprocal", [(3, r"microsoft reciprocal licen[cs]e(?: ms rl)?")]),
    ("ms-pl", "ms pl", [(2, r"ms pl")]),
    ("afl-3.0", "academic free", [(3, rf"academic free licen[cs]e(?: {_V}3 0)?")]),
    ("osl-3.0", "open software", [(3, rf"open software licen[cs]e(?: {_V}3 0)?")]),
    ("ecl-2.0", "educational community", [(3, rf"educational community licen[cs]e(?: {_V}2 0)?")]),
    ("ncsa", "ncsa", [(1, r"(?:university of illinois )?ncsa (?:open source )?licen[cs]e")]),
    ("qpl-1.0", "q public", [(3, rf"q public licen[cs]e(?: {_V}1 0)?")]),
    ("sleepycat", "sleepycat", [(1, r"sleepycat licen[cs]e")]),
    ("vim", "vim", [(1, r"vim licen[cs]e")]),
    ("w3c", "w3c", [(1, r"w3c software (?:notice and )?licen[cs]e")]),
    ("unicode", "unicode", [(1, r"unicode (?:terms of use|licen[cs]e agreement)")]),
    ("icu", "icu", [(1, r"icu licen[cs]e")]),
    ("json", "json", [(1, r"json licen[cs]e")]),
    ("json", "not evil", [(4, r"the software shall be used for good not evil")]),
    ("beerware", "beerware", [(1, r"beerware licen[cs]e")]),
    ("beerware", "beer", [(1, r"beer ware licen[cs]e"), (4, r"you can buy me a beer in return")]),
    ("imagemagick", "imagemagick", [(1, r"imagemagick licen[cs]e")]),
    ("ijg", "jpeg group", [(1, r"independent jpeg group")]),
    ("freetype", "freetype", [(1, r"freetype (?:project )?licen[cs]e")]),
    ("tcl", "tcl", [(1, r"tcl tk licen[cs]e"), (1, r"tcl licen[cs]e")]),
    ("upl-1.0", "universal permissive", [(3, rf"universal permissive licen[cs]e(?: {_V}1 0)?")]),
    ("blueoak-1.0", "blue oak", [(3, r"blue oak model licen[cs]e(?: 1 0 0)?")]),
    ("mulan-2.0", "mulan", [(3, rf"mulan (?:psl|permissive software licen[cs]e) ?{_V}2")]),
    ("bsl-1.1", "business source", [(3, r"business source licen[cs]e(?: 1 1)?")]),
    ("sspl-1.0", "side public", [(3, rf"server side public licen[cs]e(?: {_V}1)?")]),
    ("sspl-1.0", "sspl", [(2, r"sspl 1 0"), (1, r"sspl")]),
    ("elastic-2.0", "elastic", [(3, rf"elastic licen[cs]e(?: {_V}2 0)?")]),
    ("commons-clause", "commons clause", [(2, r"commons clause")]),
    ("polyform-nc", "polyform", [(3, r"polyform noncommercial licen[cs]e(?: 1 0 0)?")]),
    ("openrail-m", "openrail", [(2, r"(?:creativeml )?openrail m(?: licen[cs]e)?")]),
    ("openrail-m", "open rail", [(2, r"(?:creativeml )?open rail m(?: licen[cs]e)?")]),
    ("bigscience-rail", "rail", [(2, r"bigscience rail licen[cs]e(?: v1 0)?")]),
    ("llama-community", "llama", [(3, r"llama (?:\d )?community licen[cs]e(?: agreement)?")]),
    ("odbl-1.0", "odbl", [(2, r"odbl(?: 1 0)?")]),
    ("odbl-1.0", "open database", [(3, r"open database licen[cs]e")]),
    ("odc-by-1.0", "open data commons", [(3, r"open data commons attribution licen[cs]e")]),
    ("pddl-1.0", "public domain dedication", [(3, r"public domain dedication and licen[cs]e")]),
    ("cdla-permissive", "community data", [(3, r"community data licen[cs]e agreement permissive")]),
    ("cdla-sharing", "community data", [(3, r"community data licen[cs]e agreement sharing")]),
    ("ogl-uk-3.0", "open government", [(3, rf"open government licen[cs]e(?: {_V}3 0)?")]),
    ("gfdl", "free documentation", [
        (3, rf"gnu free documentation licen[cs]e(?: {_V}1 [123])?"),
        (4, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free "
            r"documentation license")]),
    ("all-rights-reserved", "rights reserved", [(1, r"all rights reserved")]),
    ("all-rights-reserved", "reservados", [(1, r"todos los derechos reservados")]),
    ("all-rights-reserved", "réservés", [(1, r"tous droits réservés")]),
    ("all-rights-reserved", "vorbehalten", [(1, r"alle rechte vorbehalten")]),
    ("proprietary", "proprietary", [
        (2, r"(?:proprietary and confidential|confidential and proprietary)"), (2, r"proprietary licen[cs]e")]),
    ("proprietary", "end user", [(2, r"end user licen[cs]e agreement")]),
    ("proprietary", "unauthorized", [(2, r"unauthorized (?:copying|reproduction|distribution) (?:of this file )?(?:via any medium )?is "
                                     r"(?:strictly )?prohibited")]),
    ("copyright-notice", "copyright", [(1, r"copyright (?:c |© )?(?:19|20)\d\d")]),
]


def _gnu() -> Iterator[tuple[str, str, int, str]]:
    """The GNU licences: three names, their versions, and the forms in which each is written."""
    for label, name, versions in (("gpl", "general", ("1", "2", "3")), ("lgpl", "lesser general", ("2 1", "3")),
                                  ("lgpl", "library general", ("2",)), ("agpl", "affero general", ("1", "3"))):
        full = f"gnu {name} public licen[cs]e"
        yield label, f"{name} public", 1, full
        for v in versions:
            tag = f"{label}-{v.replace(' ', '.')}" + ("" if " " in v else ".0")
            number = v if " " in v else f"{v}(?: 0)?"
            key = f"{name} public"
            yield f"{tag}", key, 3, rf"{full} (?:as published by the free software foundation )?(?:either )?{_V}{number}"
            yield f"{tag}", key, 4, rf"licensed under the {full} {_V}{number}"
            yield f"{tag}-or-later", key, 4, (rf"{full} (?:as published by the free software foundation )?(?:either )?{_V}{number} (?:of "
                                            r"the license )?or (?:at your option )?any later version")
            short = v if " " in v else f"{v}(?: 0)?"
            yield f"{tag}", label, 2, rf"spdx license identifier {label} {short}(?: only)?"
            yield f"{tag}-or-later", label, 3, rf"spdx license identifier {label} {short} or later"
            yield f"{tag}", label, 2, rf"{label} (?:v ?|version )?{short}(?! or later)"
            yield f"{tag}-or-later", label, 3, rf"{label} (?:v ?|version )?{short} or (?:any )?later"
            yield f"{tag}", f"{label}v{v[0]}", 2, rf"{label}v{short}(?! or later)"


def _creative_commons() -> Iterator[tuple[str, str, int, str]]:
    """Creative Commons: six terms in five versions, by short id, by name and by address; and CC0."""
    names = {"by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s",
             "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
             "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
    for terms, name in names.items():
        label = "cc-" + terms.replace(" ", "-")
        # a shorter term is contained in a longer one's detection and gives way to it
        yield label, "cc by", 2, rf"cc {terms}"
        yield label, "creative commons", 2, rf"creative commons {name}"
        yield label, "creativecommons", 2, rf"creativecommons org licenses {terms}"
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            tag = f"{label}-{v.replace(' ', '.')}"
            yield tag, "cc by", 3, rf"cc {terms} {v}"
            yield tag, "creative commons", 3, rf"creative commons {name}(?: licen[cs]e)? {v}(?: international| unported| generic)?"
            yield tag, "creativecommons", 3, rf"creativecommons org licenses {terms} {v}"
    yield "cc0-1.0", "cc0", 2, r"cc0(?: 1 0)?(?: universal)?"
    yield "cc0-1.0", "publicdomain", 2, r"creativecommons org publicdomain zero 1 0"


def rules() -> list[Rule]:
    """All rules in order: base phrases first, then the hand-written ones."""
    found = [(label, phrase, 1, phrase) for phrase, label in BASE.items()]
    found += [(label, keyword, priority, p) for label, keyword, kinds in _FAMILIES for priority, p in kinds]
    found += list(_gnu()) + list(_creative_commons())
    return [Rule(label, priority, keyword, re.compile(rf"(?<!\S)(?:{p})(?!\S)")) for label, keyword, priority, p in found]


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int
    order: int


#: white space beyond ASCII, as UTF-8
_ODD_SPACE = re.compile("|".join(c for c in map(chr, range(128, 0x3001)) if c.isspace()).encode())


class Scanner:
    """The rules behind their prefilter: a text's words are first held against one rare word of each keyword, so most
    texts run no pattern at all. Patterns see Unicode spaces as ends of words, so words are cut there too."""

    def __init__(self):
        self.rules = rules()
        self.by_word: dict[bytes, dict[str, list[int]]] = {}
        for i, r in enumerate(self.rules):
            rare = max(r.keyword.split(), key=len).encode()
            self.by_word.setdefault(rare, {}).setdefault(r.keyword, []).append(i)
        self.rare = frozenset(self.by_word)

    def detect(self, words: list[bytes]) -> tuple[str, list[Detection]]:
        """(words joined by single spaces, detections left after suppression, in order of place)."""
        raw = b" ".join(words)
        cut = raw if raw.isascii() else _ODD_SPACE.sub(b" ", raw)
        seen = words if cut is raw or cut == raw else cut.split(b" ")
        if self.rare.isdisjoint(seen):
            return "", []
        joined = raw.decode("utf-8", "surrogatepass")
        found = [Detection(*m.span(), self.rules[i].label, self.rules[i].priority, i)
                 for word in self.rare.intersection(seen) for keyword, own in self.by_word[word].items()
                 if keyword in joined for i in own for m in self.rules[i].pattern.finditer(joined)]
        return joined, suppress(found)


def suppress(found: list[Detection]) -> list[Detection]:
    """Drop what lies inside a detection that goes first: higher priority, then longer, then earlier rule; in order of place.

    One sweep over the detections by start, the longer first: whatever can hold a detection has then been met, so the
    furthest end met at its priority or a higher one decides. What is dropped may count as holding others, as what holds
    it holds them too."""
    furthest = dict.fromkeys({d.priority for d in found}, -1)
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.priority, d.order)):
        if all(end < d.end for priority, end in furthest.items() if priority >= d.priority):
            kept.append(d)
        furthest[d.priority] = max(furthest[d.priority], d.end)
    return sorted(kept)


def base_places(words: list[bytes], joined: str) -> list[tuple[int, str]]:
    """(start word, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE.items():
        if phrase in joined:
            p = [w.encode() for w in phrase.split()]
            at = -1
            while True:
                try:
                    at = words.index(p[0], at + 1)
                except ValueError:
                    break
                if words[at:at + len(p)] == p:
                    out.append((at, label))
    return out


def scan(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    A detection's start and end count characters of the words joined by single spaces; score is the highest priority
    found, of 4."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in b.column("text"):
                words = alnum_words(text.as_py())
                joined, hits = scanner.detect(words)
                base = base_places(words, joined)
                labels = {x for _, x in base} | {d.label for d in hits}
                starts = [s for s, _ in base]
                best = max([d.priority for d in hits] + [1] * bool(base), default=0)
                for c, v in zip(cols, (
                        len(words), len(base), min(starts, default=None), max(starts, default=None),
                        ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), best / 4,
                        [{"label": d.label, "start": d.start, "end": d.end, "priority": d.priority} for d in hits])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("row")] + [pa.array(c, t) for c, t in zip(cols, _ARROW)], ["row", *_NAMES])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<label:string,start:long,end:long,priority:int>>").fields])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *_NAMES)


_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
          pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]))]
