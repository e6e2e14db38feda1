"""License scans: ordered signature rules over whole texts.

The names, identifiers and wordings of licences are written by hand; each name is put into
every kind of mention, so most rules are products. Identifiers and abbreviations (SPDX's and
common ones) count in grants, tags, terms and SPDX expressions only: a bare ``mit`` is no
find. Rules run over the text's words (A-Z in lower case, joined by one space), and only those whose keyword
occurs. Overlapping finds are resolved by interval containment and priority: a find that lies
inside that of a rule of the same or higher priority is dropped, and of finds of the same
place the earlier rule wins.

Defined cases: NULL counts as empty text; it has no words, no labels and score 0. Rows are
scanned one by one, so repeated rows get equal results; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, n_finds bigint"
)

#: Phrases whose places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, keywords (one must occur), and the licence's name over words joined by single spaces.
LICENCES = [
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("lgpl", "lesser", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("mit", "mit licen|mit x11|mit expat", r"mit(?: x11| expat)? licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|new bsd|modified bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|original bsd)(?: licen[sc]e)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd)(?: licen[sc]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("edl", "eclipse", r"eclipse distribution licen[sc]e"),
    ("cddl", "common development", r"common development and distribution licen[sc]e"),
    ("cpl", "common public", r"common public licen[sc]e"),
    ("eupl", "european union", r"european union public licen[sc]e"),
    ("isc", "isc licen", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("bsl", "boost", r"boost software licen[sc]e"),
    ("artistic", "artistic", r"(?:perl |clarified )?artistic licen[sc]e"),
    ("psf", "python software", r"python software foundation licen[sc]e"),
    ("wtfpl", "wtfpl|do what the", r"(?:wtfpl|do what the fuck you want to public licen[sc]e)"),
    ("unlicense", "unlicen", r"(?:the )?unlicen[sc]e"),
    ("cc0", "cc0|creative commons zero", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by nc nd|creative commons", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)"),
    ("cc-by-nc-sa", "cc by nc sa|creative commons", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)"),
    ("cc-by-nc", "cc by nc|creative commons", r"(?:cc by nc|creative commons attribution non ?commercial)"),
    ("cc-by-nd", "cc by nd|creative commons", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)"),
    ("cc-by-sa", "cc by sa|creative commons", r"(?:cc by sa|creative commons attribution share ?alike)"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("odbl", "odbl|database licen", r"(?:odbl|open (?:data commons open )?database licen[sc]e)"),
    ("odc-by", "open data", r"open data commons attribution licen[sc]e"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e"),
    ("postgresql", "postgresql licen", r"postgresql licen[sc]e"),
    ("openssl", "openssl licen", r"openssl licen[sc]e"),
    ("php", "php licen", r"php licen[sc]e"),
    ("ruby", "ruby licen", r"ruby licen[sc]e"),
    ("vim", "vim licen", r"vim licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("upl", "universal permissive", r"universal permissive licen[sc]e"),
    ("osl", "open software", r"open software licen[sc]e"),
    ("afl", "academic free", r"academic free licen[sc]e"),
    ("sspl", "server side", r"server side public licen[sc]e"),
    ("busl", "business source", r"business source licen[sc]e"),
    ("elastic", "elastic licen", r"elastic licen[sc]e"),
    ("llama", "llama", r"llama(?: \d+)*? community licen[sc]e"),
    ("openrail", "openrail|open rail", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[sc]e)?"),
    ("public-domain", "public domain", r"(?:dedicated to|released into|placed in|in) the public domain"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("apsl", "apple public", r"apple public source licen[sc]e"),
    ("cecill", "cecill", r"cecill(?: (?:a|b|c))?(?: free software)? licen[sc]e"),
    ("ecl", "educational community", r"educational community licen[sc]e"),
    ("efl", "eiffel forum", r"eiffel forum licen[sc]e"),
    ("ipl", "ibm public", r"ibm public licen[sc]e"),
    ("lppl", "latex project", r"latex project public licen[sc]e"),
    ("mulanpsl", "mulan", r"mulan permissive software licen[sc]e"),
    ("npl", "netscape public", r"netscape public licen[sc]e"),
    ("qpl", "q public", r"q public licen[sc]e"),
    ("rpl", "reciprocal public", r"reciprocal public licen[sc]e"),
    ("sissl", "sun industry", r"sun industry standards source licen[sc]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e"),
    ("spl", "sun public", r"sun public licen[sc]e"),
    ("w3c", "w3c", r"w3c software(?: notice)?(?: and)?(?: document)? licen[sc]e"),
    ("beerware", "beer", r"beer ?ware licen[sc]e"),
    ("blueoak", "blue oak", r"blue oak model licen[sc]e"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer"),
    ("curl", "curl licen", r"curl licen[sc]e"),
    ("icu", "icu licen", r"icu licen[sc]e"),
    ("unicode", "unicode", r"unicode(?: data files and software)? licen[sc]e"),
    ("libpng", "png reference", r"png reference library licen[sc]e"),
    ("ijg", "independent jpeg", r"independent jpeg group licen[sc]e"),
    ("tcl", "tcl tk licen|tcl licen", r"tcl(?: tk)? licen[sc]e"),
    ("ftl", "freetype", r"freetype(?: project)? licen[sc]e"),
    ("oldap", "openldap", r"open ?ldap public licen[sc]e"),
    ("pddl", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[sc]e"),
    ("cdla", "community data", r"community data licen[sc]e agreement"),
    ("zpl", "zope public", r"zope public licen[sc]e"),
    ("miros", "miros licen", r"miros licen[sc]e"),
    ("json", "json licen", r"json licen[sc]e"),
    ("rail", "responsible ai", r"(?:bigscience )?responsible ai licen[sc]e"),
]

_V = r"(?: ?v| version)?(?: ?\d+(?: \d+)*)?(?: only| or later| or newer| or(?: at your option)? any later version)?(?: licen[sc]e)?"

#: Label, keywords (each after another word), and the licence's SPDX identifiers
#: and abbreviations without versions, over words. They count in ``KINDS`` with ``short`` only.
IDENTIFIERS = [
    ("agpl", " agpl| gnu agpl", r"(?:gnu )?agpl"),
    ("lgpl", " lgpl| gnu lgpl", r"(?:gnu )?lgpl(?:lr)?"),
    ("gfdl", " gfdl| fdl| gnu fdl", r"(?:gnu )?(?:g?fdl)"),
    ("gpl", " gpl| gnu gpl", r"(?:gnu )?gpl"),
    ("apache", " apache| asl", r"(?:apache(?: software)?|asl 2|asl 1 1)"),
    ("mit", " mit| expat", r"(?:mit(?: 0| x11| expat| cmu| modern variant)?|expat)"),
    ("bsd-2-clause", " bsd| simplified bsd| freebsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: patent| views)?"),
    ("bsd-3-clause", " bsd| new bsd| 3 clause| three clause| modified bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)(?: clear| lbnl| attribution)?"),
    ("bsd-4-clause", " bsd| 4 clause| four clause| original bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: uc)?"),
    ("0bsd", " 0bsd| bsd 0| zero clause", r"(?:0bsd|bsd 0 clause|bsd zero clause|zero clause bsd)"),
    ("bsd", " bsd", r"bsd(?: style)?"),
    ("mpl", " mpl", r"mpl"),
    ("epl", " epl", r"epl"),
    ("edl", " edl", r"edl"),
    ("cddl", " cddl", r"cddl"),
    ("cpl", " cpl", r"cpl"),
    ("eupl", " eupl", r"eupl"),
    ("isc", " isc", r"isc"),
    ("zlib", " zlib", r"zlib(?: acknowledgement)?"),
    ("bsl", " bsl 1 0| bsl1 0| boost", r"(?:bsl ?1 0|boost(?: software)?(?: licen[sc]e)?)"),
    ("artistic", " artistic| clartistic", r"(?:cl)?artistic"),
    ("psf", " psf| python", r"(?:psfl?|python 2 0(?: 1)?)"),
    ("wtfpl", " wtfpl", r"wtfpl"),
    ("unlicense", " unlicen| the unlicen", r"(?:the )?unlicen[sc]e"),
    ("cc0", " cc0| cc 0", r"cc ?0(?: universal)?"),
    ("cc-by-nc-nd", " cc by nc nd", r"cc by nc nd"),
    ("cc-by-nc-sa", " cc by nc sa", r"cc by nc sa"),
    ("cc-by-nc", " cc by nc", r"cc by nc"),
    ("cc-by-nd", " cc by nd", r"cc by nd"),
    ("cc-by-sa", " cc by sa", r"cc by sa"),
    ("cc-by", " cc by", r"cc by"),
    ("odbl", " odbl", r"odbl"),
    ("odc-by", " odc by", r"odc by"),
    ("ofl", " ofl| sil ofl", r"(?:sil )?ofl"),
    ("postgresql", " postgresql", r"postgresql"),
    ("openssl", " openssl", r"openssl(?: standalone)?"),
    ("php", " php", r"php"),
    ("ruby", " ruby", r"ruby"),
    ("vim", " vim", r"vim"),
    ("ms-pl", " ms pl| mspl", r"ms ?pl"),
    ("ms-rl", " ms rl| msrl", r"ms ?rl"),
    ("upl", " upl", r"upl"),
    ("osl", " osl", r"osl"),
    ("afl", " afl", r"afl"),
    ("sspl", " sspl", r"sspl"),
    ("busl", " busl| bsl 1 1| bsl1 1", r"(?:busl|bsl(?= ?1 1))"),
    ("elastic", " elastic| elv2", r"(?:elastic|elv2)"),
    ("llama", " llama", r"llama"),
    ("openrail", " openrail| open rail| creativeml| bigscience| bigcode", r"(?:creativeml |bigscience |bigcode )?open ?rail(?: ?[msd])?"),
    ("public-domain", " public domain| cc pddc", r"(?:public domain|cc pddc)"),
    ("ncsa", " ncsa", r"ncsa"),
    ("apsl", " apsl", r"apsl"),
    ("cecill", " cecill", r"cecill(?: [abc])?"),
    ("ecl", " ecl", r"ecl"),
    ("efl", " efl", r"efl"),
    ("ipl", " ipl", r"ipl"),
    ("lppl", " lppl", r"lppl"),
    ("mulanpsl", " mulanpsl| mulan psl", r"mulan ?psl"),
    ("npl", " npl", r"npl"),
    ("qpl", " qpl", r"qpl"),
    ("rpl", " rpl", r"rpl"),
    ("sissl", " sissl", r"sissl"),
    ("sleepycat", " sleepycat", r"sleepycat"),
    ("spl", " spl", r"spl"),
    ("w3c", " w3c", r"w3c"),
    ("beerware", " beerware| beer ware", r"beer ?ware"),
    ("blueoak", " blueoak| blue oak", r"blue ?oak"),
    ("hpnd", " hpnd", r"hpnd"),
    ("curl", " curl", r"curl"),
    ("icu", " icu", r"icu"),
    ("unicode", " unicode", r"unicode(?: dfs| tou| 3)?"),
    ("libpng", " libpng", r"libpng"),
    ("ijg", " ijg", r"ijg"),
    ("tcl", " tcl", r"tcl"),
    ("ftl", " ftl", r"ftl"),
    ("oldap", " oldap", r"oldap"),
    ("pddl", " pddl", r"pddl"),
    ("cdla", " cdla", r"cdla(?: permissive| sharing)?"),
    ("zpl", " zpl", r"zpl"),
    ("miros", " miros", r"miros"),
    ("json", " json", r"json"),
    ("rail", " bigscience bloom rail", r"bigscience bloom rail"),
]
#: Labels whose identifiers are common words: ``see the``, ``under the`` and the like need "licence" after them.
WORDS = {"mit", "apache", "isc", "zlib", "bsl", "artistic", "psf", "postgresql", "openssl", "php", "ruby", "vim", "elastic", "llama", "public-domain", "sleepycat", "w3c", "curl", "icu", "unicode", "tcl", "json", "bsd"}
_ANY_ID = "(?:" + "|".join(sorted((p for _, _, p in IDENTIFIERS), key=len, reverse=True)) + ")" + _V

#: Kind of mention, its rank (first wins), its weight, its pattern around a name;
#: ``{short}`` stands for the name or an identifier with its version. A find's place is the
#: group ``at`` where there is one.
KINDS = [
    ("grant", 0, 1.0, r"(?:re)?(?:licen[sc]ed|released|distributed|available|published|redistribute it) under(?: the terms of)?(?: the| a| an)? {short}(?: version \d+(?: \d+)*| \d+ \d+)?"),
    ("tag", 1, 1.0, r"(?:spdx licen[sc]e identifier|licen[sc]e) (?:is )?(?:the )?{short}(?: version \d+(?: \d+)*| \d+ \d+)?"),
    ("operand", 1, 1.0, r"spdx licen[sc]e identifier (?:{any}(?: with(?: [a-z0-9]+){1,6}?)? (?:or|and) )+(?P<at>{id})"),
    ("terms", 2, 0.9, r"(?:(?:terms of|conditions of|subject to|governed by|copy of|see|under) the {name}(?: version \d+(?: \d+)*)?|(?:terms of|conditions of|subject to|governed by) the {id}|(?:copy of|see|under) the {sure})"),
    ("version", 3, 0.8, r"{name}(?: version| v)? \d+(?: \d+)*(?: or(?: at your option)? any later version)?"),
    ("name", 4, 0.6, r"{name}"),
]

#: Wordings of single licences: label, keywords, pattern.
WORDINGS = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved", r"all rights reserved"),
    ("mit", "above copyright notice and this permission", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache", "compliance with the licen", r"you may not use this file except in compliance with the licen[sc]e"),
    ("gpl", "without even the implied", r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty"),
    ("lgpl", "without even the implied", r"this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty"),
    ("agpl", "interact with it remotely|affero", r"interact with it remotely through a(?:ny)? computer network|affero general public licen[sc]e as published by the free software foundation"),
    ("gfdl", "invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("bsl", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("wtfpl", "you just do what", r"you just do what the fuck you want to"),
    ("cc0", "associated a work", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("ofl", "reserved font", r"with reserved font name"),
    ("postgresql", "without a written agreement", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "in supporting documentation", r"both that copyright notice and this permission notice appear in supporting documentation"),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project"),
    ("beerware", "buy me a beer", r"you can buy me a beer in return"),
    ("ijg", "independent jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("ftl", "freetype", r"portions of this software are copyright (?:c )?(?:\d+ )*the freetype project"),
    ("w3c", "w3c", r"w3c software and document notice and licen[sc]e"),
    ("json", "used for good", r"the software shall be used for good not evil"),
    ("public-domain", "copyright to this source", r"the authors? (?:hereby )?disclaims? copyright to this source code"),
    ("cc-by", "creativecommons", r"creativecommons org licen[sc]es by \d 0"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licen[sc]es by sa \d 0"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licen[sc]es by nc \d 0"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licen[sc]es by nd \d 0"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licen[sc]es by nc sa \d 0"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licen[sc]es by nc nd \d 0"),
    ("cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("gpl", "gnu org", r"www gnu org licen[sc]es gpl(?: \d 0)?"),
    ("apache", "apache org", r"www apache org licen[sc]es licen[sc]e 2 0"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    rank: int
    weight: float
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules, in order of priority: wordings, then every kind of mention of every licence."""
    found = [Rule(label, "wording", -1, 1.0, keyword, pattern) for label, keyword, pattern in WORDINGS]
    ids = {label: (keywords, pattern) for label, keywords, pattern in IDENTIFIERS}
    for kind, rank, weight, around in KINDS:
        for label, keyword, name in LICENCES:
            keywords, short = ids[label]
            each = {"name": f"(?:{name})", "id": f"(?:{short}){_V}", "any": _ANY_ID}
            each["short"] = f"(?:{each['name']}|{each['id']})"
            each["sure"] = f"(?:{short}){_V}" + ("(?<=licen[sc]e)" if label in WORDS else "")
            used = re.findall(r"{([a-z]+)}", around)
            words = ([keyword] if {"name", "short"} & set(used) else []) + ([keywords] if set(used) - {"name"} else [])
            pattern = re.sub(r"{([a-z]+)}", lambda m: each[m[1]], around)
            found.append(Rule(label, kind, rank, weight, "|".join(words), pattern))
    return found


_TO_SPACE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))


class Scanner:
    """All rules made ready: an automaton over the keywords gates the expressions."""

    def __init__(self, rule_list: list[Rule]):
        self.rules = [(r, re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])".encode())) for r in rule_list]
        self.automaton = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for i, r in enumerate(rule_list):
            for word in r.keyword.split("|"):
                by_word.setdefault(word, []).append(i)
        for word, which in by_word.items():
            self.automaton.add_word(word, which)
        self.automaton.make_automaton()

    def finds(self, text: bytes) -> list[tuple[int, int, Rule]]:
        """Finds that stay after containment and priority, by place."""
        plain = text.decode("latin-1")  # a character per byte; keywords are ASCII
        gated = sorted({i for _, which in self.automaton.iter(plain) for i in which})
        found = sorted(
            (m.start(at), -m.end(at), i)
            for i in gated for at in (1 if self.rules[i][1].groups else 0,) for m in self.rules[i][1].finditer(text)
        )
        kept: list[tuple[int, int, Rule]] = []
        reaching: list[tuple[int, int]] = []  # ends and ranks of kept finds that go on here
        for start, end, i in found:  # outer finds come first; those of a place by rule order
            rule = self.rules[i][0]
            reaching = [(e, rank) for e, rank in reaching if e > start]
            if not any(-end <= e and rank <= rule.rank for e, rank in reaching):
                kept.append((start, -end, rule))
                reaching.append((-end, rule.rank))
        return kept


def scan(text: bytes, scanner: Scanner, base: dict[str, str] = BASE) -> tuple:
    """One text's row, as in SCHEMA without the id."""
    words = text.translate(_TO_SPACE).split()
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    places, base_labels = [], set()
    for phrase, label in base.items():
        p = phrase.encode()
        at = joined.find(p)
        while at >= 0:
            before, after = joined[at - 1 : at], joined[at + len(p) : at + len(p) + 1]
            if (at == 0 or before == b" ") and after in (b"", b" "):
                places.append(int(np.searchsorted(blanks, at)))
                base_labels.add(label)
            at = joined.find(p, at + 1)
    finds = scanner.finds(joined)
    labels = base_labels | {r.label for _, _, r in finds}
    score = 1.0 if base_labels else max((r.weight for _, _, r in finds), default=0.0)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, len(finds),
    )


def license_scan(docs: DataFrame, rule_list: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: places of base phrases, labels, score; nothing is shuffled."""
    chosen = rules() if rule_list is None else rule_list
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            rows = [scan(t or b"", scanner) for t in texts]
            columns = list(zip(*rows)) if rows else [()] * 8
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    return docs.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(run, SCHEMA)
