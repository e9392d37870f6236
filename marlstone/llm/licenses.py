"""License scans: ordered signature rules over normalised words.

A text becomes its words ([0-9a-z] and non-ASCII bytes, A-Z lower-cased) joined
by single blanks, so "Apache License, Version 2.0" reads
"apache license version 2 0".  Each rule is a regular expression over such
words with a label, a priority and the keywords without which it cannot match;
rules whose keywords a text lacks are not run.  Rules come from LICENSES by the
forms in FORMS, some are stated by hand in NOTICES.

Overlapping detections are resolved in the order of priority, then length, then
place: one whose interval lies inside that of a detection kept before is
suppressed.  The base phrases are found on their own, and their labels always stay.

Edge cases: null and empty text has no words, no place (first_word and
last_word null), empty label lists and score 0; texts are scanned whole,
whatever their length, in time that grows with it; equal detections of one
interval stay once; repeated rows each keep their row; an empty table gives no
rows; input columns named like an output are replaced.
"""

from __future__ import annotations

import functools
import itertools
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .decontam import normaliser
from .textvec import pieces

#: Base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label: (name as a regex over words, a keyword every match of the name contains, SPDX id in words).
LICENSES = {
    "mit": (r"mit", " mit ", "mit"),
    "mit-0": (r"mit no attribution", " no attribution ", "mit 0"),
    "x11": (r"(?:mit )?x11", " x11 ", "x11"),
    "isc": (r"isc", " isc ", "isc"),
    "0bsd": (r"(?:0bsd|zero clause bsd)", "bsd ", "0bsd"),
    "bsd-2": (r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", "bsd ", "bsd 2 clause"),
    "bsd-3": (r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", " bsd ", "bsd 3 clause"),
    "bsd-4": (r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)", " bsd ", "bsd 4 clause"),
    "bsd": (r"bsd(?: style)?", " bsd ", "bsd"),
    "apache-1": (r"apache(?: software)?(?: license)? (?:version )?v?1(?: [01])?", " apache ", "apache 1 [01]"),
    "apache-2": (r"apache(?: software)?(?: license)? (?:version )?v?2(?: 0)?", " apache ", "apache 2 0"),
    "apache": (r"apache(?: software)?", " apache ", "apache"),
    "gpl-1": (r"(?:gnu )?(?:gpl|general public license) (?:version )?v?1(?: 0)?", "gpl|general public", "gpl 1 0(?: only| or later)?"),
    "gpl-2": (r"(?:gnu )?(?:gpl|general public license) (?:version )?v?2(?: 0)?", "gpl|general public", "gpl 2 0(?: only| or later)?"),
    "gpl-3": (r"(?:gnu )?(?:gpl|general public license) (?:version )?v?3(?: 0)?", "gpl|general public", "gpl 3 0(?: only| or later)?"),
    "gpl": (r"(?:gnu )?(?:gpl|general public)", "gpl|general public", "gpl"),
    "lgpl-2": (r"(?:gnu )?(?:lgpl|library general public license) (?:version )?v?2(?: 0)?", "lgpl|library general", "lgpl 2 0(?: only| or later)?"),
    "lgpl-2.1": (r"(?:gnu )?(?:lgpl|lesser general public license) (?:version )?v?2 1", "lgpl|lesser general", "lgpl 2 1(?: only| or later)?"),
    "lgpl-3": (r"(?:gnu )?(?:lgpl|lesser general public license) (?:version )?v?3(?: 0)?", "lgpl|lesser general", "lgpl 3 0(?: only| or later)?"),
    "lgpl": (r"(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "lgpl|general public", "lgpl"),
    "agpl-3": (r"(?:gnu )?(?:agpl|affero general public license) (?:version )?v?3(?: 0)?", "agpl|affero", "agpl 3 0(?: only| or later)?"),
    "agpl": (r"(?:gnu )?(?:agpl|affero general public)", "agpl|affero", "agpl"),
    "gfdl": (r"(?:gnu )?(?:gfdl|free documentation)", "gfdl|free documentation", "gfdl 1 [123](?: only| or later)?"),
    "mpl-1": (r"(?:mpl|mozilla public license) (?:version )?v?1(?: [01])?", " mpl|mozilla", "mpl 1 [01]"),
    "mpl-2": (r"(?:mpl|mozilla public license) (?:version )?v?2(?: 0)?", " mpl|mozilla", "mpl 2 0"),
    "mpl": (r"(?:mpl|mozilla public)", " mpl|mozilla", "mpl"),
    "epl-1": (r"(?:epl|eclipse public license) (?:version )?v?1(?: 0)?", " epl|eclipse", "epl 1 0"),
    "epl-2": (r"(?:epl|eclipse public license) (?:version )?v?2(?: 0)?", " epl|eclipse", "epl 2 0"),
    "cddl": (r"(?:cddl|common development and distribution)", "cddl|common development", "cddl 1 [01]"),
    "cpl": (r"(?:cpl|common public)", " cpl|common public", "cpl 1 0"),
    "eupl": (r"(?:eupl|european union public)", "eupl|european union", "eupl 1 [012]"),
    "artistic-1": (r"(?:perl )?artistic(?: license)? (?:version )?1(?: 0)?", " artistic ", "artistic 1 0"),
    "artistic-2": (r"(?:perl )?artistic(?: license)? (?:version )?2(?: 0)?", " artistic ", "artistic 2 0"),
    "artistic": (r"(?:perl )?artistic", " artistic ", "artistic"),
    "boost": (r"boost(?: software)?", " boost ", "bsl 1 0"),
    "zlib": (r"zlib(?: libpng)?", " zlib ", "zlib"),
    "libpng": (r"libpng", " libpng ", "libpng"),
    "unlicense": (r"unlicense", " unlicense ", "unlicense"),
    "wtfpl": (r"(?:wtfpl|do what the fuck you want to public)", "wtfpl|do what the", "wtfpl"),
    "python": (r"(?:python software foundation|psf)", "python software| psf ", "(?:psf|python) 2 0"),
    "ruby": (r"ruby", " ruby ", "ruby"),
    "php": (r"php", " php ", "php 3 01?"),
    "postgresql": (r"postgresql", " postgresql ", "postgresql"),
    "openssl": (r"openssl", " openssl ", "openssl"),
    "ofl": (r"(?:sil )?(?:ofl|open font)", " ofl|open font", "ofl 1 [01]"),
    "ms-pl": (r"(?:ms pl|microsoft public)", " ms pl|microsoft public", "ms pl"),
    "ms-rl": (r"(?:ms rl|microsoft reciprocal)", " ms rl|microsoft reciprocal", "ms rl"),
    "ncsa": (r"(?:university of illinois ncsa(?: open source)?|ncsa)", " ncsa ", "ncsa"),
    "upl": (r"universal permissive", " permissive ", "upl 1 0"),
    "bsl": (r"business source", " business ", "busl 1 1"),
    "sspl": (r"(?:sspl|server side public)", "sspl|server side", "sspl 1 0"),
    "elastic": (r"elastic", " elastic ", "elastic 2 0"),
    "odbl": (r"(?:odbl|open (?:data commons )?database)", "odbl| database", "odbl 1 0"),
    "odc-by": (r"(?:odc by|open data commons attribution)", "odc by|open data commons", "odc by 1 0"),
    "cdla": (r"community data license agreement", " community ", "cdla permissive [12] 0"),
    "cc0": (r"(?:cc0|cc zero|creative commons zero)(?: 1 0)?", "cc0|cc zero|creative commons zero", "cc0 1 0"),
    "cc-by-nc-nd": (r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1234] [05])?", "cc by nc nd|attribution non", "cc by nc nd [1234] [05]"),
    "cc-by-nc-sa": (r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] [05])?", "cc by nc sa|attribution non", "cc by nc sa [1234] [05]"),
    "cc-by-nc": (r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] [05])?", "cc by nc|attribution non", "cc by nc [1234] [05]"),
    "cc-by-nd": (r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1234] [05])?", "cc by nd|attribution no", "cc by nd [1234] [05]"),
    "cc-by-sa": (r"(?:cc by sa|creative commons attribution share ?alike)(?: [1234] [05])?", "cc by sa|attribution share", "cc by sa [1234] [05]"),
    "cc-by": (r"(?:cc by|creative commons attribution)(?: [1234] [05])?", "cc by|creative commons attribution", "cc by [1234] [05]"),
}

#: (form, priority, keywords): {name} and {spdx} stand for a license's.
FORMS = (
    (r"spdx license identifier {spdx}", 100, (" spdx ",)),
    (r"licen[cs]e {spdx}", 85, (" licen",)),
    (r"(?:licensed|released|distributed|published|available|provided|offered|covered|redistributed) under (?:the )?(?:terms of (?:the )?)?{name}(?: (?:public )?licen[cs]e)?(?: (?:as published by the free software foundation|or (?:any )?later(?: version)?|only|or newer))?", 90, (" under ",)),
    (r"(?:subject to|governed by|according to|in accordance with) (?:the )?(?:terms of (?:the )?)?{name}(?: (?:public )?licen[cs]e)?", 80, (" subject to | governed by | according to | accordance with ",)),
    (r"(?:dual|multi|triple) licensed (?:under )?(?:the )?{name}", 75, (" licensed ",)),
    (r"under (?:the )?(?:terms of (?:the )?)?{name} licen[cs]e", 70, (" under ", " licen")),
    (r"{name}(?: international)?(?: (?:public )?licen[cs]e)(?: agreement)?(?: (?:version )?v?\d+(?: \d+)?)?", 60, (" licen",)),
    (r"(?:opensource org|spdx org|choosealicense com)(?: \w+)? licenses? {spdx}", 95, (" license",)),
)

#: The form and priority of a name that says its version, or names a Creative Commons license: it stands for itself.
ALONE = (r"{name}", 65, ())

#: Notices that name no license by its usual name: (label, regex, priority, keywords).
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 88, (" hereby granted ",)),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 88, (" without fee ",)),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 86, (" binary forms ",)),
    ("bsd-3", r"neither the name of (?:the )?(?:\S+ ){1,12}?nor the names of its contributors may be used to endorse", 87, (" endorse ",)),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 86, (" held liable ",)),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 88, (" unencumbered ",)),
    ("public-domain", r"(?:dedicated to|released into|placed in|in) the public domain", 50, (" public domain ",)),
    ("proprietary", r"all rights reserved", 30, (" rights reserved ",)),
    ("proprietary", r"proprietary and confidential", 40, (" proprietary ",)),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", 20, (" copyright ",)),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 92, (" free software ",)),
    ("cc", r"creative commons org licen[cs]es (?:by|zero)(?: \w\w)*", 75, (" creative commons ", " licen")),
    ("cc-by-nc", r"attribution non ?commercial(?: [1234] [05])?", 65, (" attribution ",)),
    ("cc-by-sa", r"attribution share ?alike(?: [1234] [05])?", 65, (" attribution ",)),
)


class Rule(NamedTuple):
    label: str
    priority: int
    needs: tuple[tuple[bytes, ...], ...]  # of each group one must occur
    pattern: re.Pattern


def spdx_keyword(spdx: str) -> str:
    """What every match of an identifier begins with."""
    first = spdx.split()[0]
    return "|".join(f" {w}" for w in first.strip("(?:)").split("|"))


@functools.cache
def rules() -> list[Rule]:
    made = [(label, form.format(name=name, spdx=spdx), priority, (keyword if "{name}" in form else spdx_keyword(spdx), *needs)) for label, (name, keyword, spdx) in LICENSES.items() for form, priority, needs in (*FORMS, *[ALONE] * ("version" in name or "creative" in name))]
    made += [(label, pattern, priority, needs) for label, pattern, priority, needs in NOTICES]
    order = sorted(range(len(made)), key=lambda i: (-made[i][2], i))
    return [Rule(made[i][0], made[i][2], tuple(tuple(w.encode() for w in n.split("|")) for n in made[i][3]), re.compile(rf"(?<= ){made[i][1]}(?= )".encode())) for i in order]


class Detection(NamedTuple):
    first: int
    last: int
    label: str
    priority: int


def detect(flat: bytes) -> list[Detection]:
    """All detections in words joined by blanks, with a blank before and after."""
    present: dict[bytes, bool] = {}

    def has(word: bytes) -> bool:
        if word not in present:
            present[word] = word in flat
        return present[word]

    out: list[Detection] = []
    blanks = None
    for rule in rules():
        if all(any(map(has, group)) for group in rule.needs):
            for m in rule.pattern.finditer(flat):
                if blanks is None:
                    blanks = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
                first, last = np.searchsorted(blanks, (m.start(), m.end())).tolist()
                out.append(Detection(first - 1, last - 1, rule.label, rule.priority))
    return out


def covered(first: np.ndarray, last: np.ndarray, by_first: np.ndarray, by_last: np.ndarray) -> np.ndarray:
    """Which of the intervals lie inside one of the others (sorted by first)."""
    if not len(by_first):
        return np.zeros(len(first), bool)
    furthest = np.maximum.accumulate(by_last)
    at = np.searchsorted(by_first, first, "right") - 1
    return (at >= 0) & (furthest[np.maximum(at, 0)] >= last)


def resolve(found: list[Detection]) -> list[Detection]:
    """Those that lie inside no detection of a higher priority, nor, in their own, inside a longer one (of equal intervals the first label stays).

    A suppressed detection lies inside a kept one, so all of a higher priority count, kept or not.
    """
    higher = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    kept: list[Detection] = []
    rest = sorted(set(found), key=lambda d: (-d.priority, d.first, -d.last, d.label))
    for _, same in itertools.groupby(rest, key=lambda d: d.priority):
        own = list(same)
        first, last = (np.array([getattr(d, c) for d in own], np.int64) for c in ("first", "last"))
        before = np.concatenate(([-1], np.maximum.accumulate(last)[:-1]))
        gone = covered(first, last, *higher) | (before >= last)
        kept += [d for d, g in zip(own, gone, strict=True) if not g]
        both = np.concatenate((higher[0], first)), np.concatenate((higher[1], last))
        order = np.argsort(both[0], kind="stable")
        higher = both[0][order], both[1][order]
    return sorted(kept)


def base_places(flat: bytes) -> list[Detection]:
    out = []
    for phrase, label in BASE.items():
        framed = f" {phrase} ".encode()
        starts, at = [], flat.find(framed)
        while at >= 0:
            starts.append(at)
            at = flat.find(framed, at + 1)
        if starts:
            words = np.searchsorted(np.flatnonzero(np.frombuffer(flat, np.uint8) == 32), starts).tolist()
            out += [Detection(first, first + phrase.count(" "), label, 100) for first in words]
    return out


def _scan(batches):
    import pyarrow as pa

    split = normaliser()
    for batch in pieces(batches, "_text"):
        cols: list[list] = [[] for _ in range(8)]
        for raw in batch.column("_text").to_pylist():
            words = split(raw or b"")
            flat = b" " + b" ".join(words) + b" "
            base, kept = base_places(flat), resolve(detect(flat)) if words else []
            starts, labels = [d.first for d in base], sorted({d.label for d in base})
            row = (
                len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(labels), ",".join(sorted({*labels, *(d.label for d in kept)})),
                max((d.priority / 100 for d in (*base, *kept)), default=0.0), [d._asdict() for d in kept],
            )
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), spans)
        keep = [i for i, n in enumerate(batch.schema.names) if n != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*(batch.schema.names[i] for i in keep), *MADE])


MADE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<first:long,last:long,label:string,priority:long>>"


def scan_licenses(documents: DataFrame) -> DataFrame:
    """documents with the columns of FIELDS, in place of text."""
    # Other columns travel under names of their own, so that none of them clashes.
    names = [c for c in documents.columns if c not in MADE and c != "text"]
    rows = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("text").cast("binary").alias("_text"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    out = rows.mapInArrow(_scan, kept + FIELDS)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *MADE)


def query(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("detections")
