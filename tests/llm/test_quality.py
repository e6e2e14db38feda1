"""Compression bands, language ID and licence rules, row by row."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest
import zstandard

from tests.conftest import DATA
from txnkpi.llm import compression, langid, licenses
from txnkpi.llm.common import LOWER, UPPER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_are_those_of_plain_python(spark, edge):
    for docs in (edge, spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")):
        want = Counter((r.doc_id, *_counts(r.text)) for r in docs.collect())
        got = compression.quality_rules(docs).collect()
        assert Counter(tuple(r)[:7] for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)


def test_verdicts_follow_the_bands(spark):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=60)) for _ in range(200))
    prose = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").filter("n_chars > 6000").first().text
    rows = [(1, noise), (2, " ".join(f"w{i % 9}" for i in range(900))), (3, prose)]
    got = {r.doc_id: r for r in compression.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not got[1].kept and got[1].ratio > 0.7
    assert not got[2].kept
    assert got[3].kept
    half = prose[: len(prose) // 2] + " ".join(f"x{i}" for i in [7] * 9000)
    verdict = compression.judge(half, compression.Bands(), zstandard.ZstdCompressor(level=3))
    assert verdict[9] > 0 and not verdict[6]


def test_noise_of_any_alphabet_and_length(spark):
    letters, compress, bands = "abcdefghijklmnopqrstuvwxyz", zstandard.ZstdCompressor(level=3), compression.Bands()
    kept = lambda text: compression.judge(text, bands, compress)[6]
    alphabets = ["0123456789abcdef", "0123456789", letters, letters.upper() + "234567", letters + letters.upper() + "0123456789+/", "".join(map(chr, range(33, 127)))]
    docs = [r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect() if r.text]
    prose = [t for t in docs if compression.judge(t, compression.Bands(noise_bytes=1 << 40), compress)[6]]
    for size in (500, 700, 1500, 3000, 4095, 4096, 8000, 8191):
        for alphabet in alphabets:
            for width in (5, 8, 16):
                rng = random.Random(size * width)
                noise = " ".join("".join(rng.choices(alphabet, k=width)) for _ in range(size // width + 1))[:size]
                assert not kept(noise), (size, width, alphabet)
        cut = [t.encode()[:size].decode(errors="ignore") for t in prose if len(t.encode()) >= size]
        good = [t for t in cut if not compression.judge(t, bands, compress)[5]]
        assert all(map(kept, good)) and (good or size > 4096)
    rng = random.Random(5)
    clean = max(prose, key=len).encode()[:4096].decode(errors="ignore")
    tail = " ".join("".join(rng.choices("0123456789abcdef", k=8)) for _ in range(400))
    verdict = compression.judge(clean + " " + tail, bands, compress)
    assert kept(clean) and verdict[8:] == (2, 1) and not verdict[6]


def test_keep_good_keeps_rows_whole(edge, empty):
    kept = compression.keep_good(edge)
    assert kept.columns == edge.columns
    want = Counter((r.doc_id, r.n_words) for r in compression.quality_rules(edge).collect() if r.kept)
    assert Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in kept.collect()) == want
    assert compression.keep_good(empty).count() == compression.quality_rules(empty).count() == 0


def _code_length(train, order, text):
    counts: dict[bytes, Counter] = {}
    for t in train:
        padded = b"\0" * order + t
        for m in range(order + 1):
            for i in range(order, len(padded)):
                counts.setdefault(padded[i - m : i], Counter())[padded[i]] += 1
    padded, bits = b"\0" * order + text, 0.0
    for i in range(order, len(padded)):
        for m in range(order, -2, -1):
            if m < 0:
                bits += 8
                break
            seen = counts.get(padded[i - m : i])
            if seen is None:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits += math.log2((total + distinct) / seen[padded[i]])
                break
            bits += math.log2((total + distinct) / distinct)
    return bits


def test_code_lengths_are_exact():
    train = {"en": [b"the cat sat on the mat", b"then there"], "de": ["die Katze saß".encode()]}
    for order in (0, 1, 2, 3):
        model = langid.Model(train, order)
        for text in (b"the hat", "saß on z".encode(), b"", b"q"):
            got = model.lengths([text, b"x"])[0]
            want = [_code_length(train[lang], order, text) for lang in model.languages]
            assert all(abs(g - w) < 1e-9 for g, w in zip(got, want))


def test_held_out_accuracy(spark):
    from txnkpi.llm.queries import queries

    folder = f"{DATA}/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = [r for r in queries()["op4_ppm_language"](spark, folder).collect() if r.held_out]
    assert len(got) > 250
    assert sum(r.lang_pred == langs[r.doc_id] for r in got) >= 0.97 * len(got)


def test_language_of_odd_rows(spark, edge, empty):
    model = langid.learn(edge)
    got = {(r.doc_id, r.lang_pred): r.score for r in langid.predict(edge, model).collect()}
    assert got[4, "und"] == got[5, "und"] == got[6, "und"] == 0
    assert all(0 <= s <= 1 for s in got.values())
    nothing = langid.learn(empty)
    assert {r.lang_pred for r in langid.predict(edge, nothing).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_training_reads_no_held_out_row(spark, edge):
    model = langid.learn(edge.filter("lang = 'de'"))
    assert model.languages == ["de"]


ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _base(text):
    words = ALNUM_WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_phrases_are_those_of_plain_python(spark, edge):
    extra = [
        (100, "MIT License mit-license. The Apache License, GNU General\nPublic License cc by cc.by xcc by mit licenses"),
        (101, "cc by cc by"), (102, "É mit license É"),
    ]
    for docs in (edge, spark.createDataFrame(extra, "doc_id bigint, text string"), spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")):
        want = Counter((r.doc_id, *_base(r.text)) for r in docs.collect())
        got = licenses.license_scan(docs).collect()
        assert Counter(tuple(r)[:6] for r in got) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_rules_priority_and_containment():
    scanner = licenses.Scanner(licenses.rules())
    finds = scanner.finds(b"this is licensed under the apache license version 2 0 and the lesser general public license")
    assert [(r.label, r.kind) for _, _, r in finds] == [("apache", "grant"), ("lgpl", "name")]
    assert scanner.finds(b"permitted for the mitigation of licenses") == []
    assert 200 <= len(licenses.rules()) < 1000


def test_gated_rules_find_what_all_rules_find(spark):
    chosen = licenses.rules()
    scanner = licenses.Scanner(chosen)
    texts = [r.text.lower() for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    texts += [f"released under the {name} license version 2 0" for name in ("mit", "zlib", "mozilla public", "cc by nc", "openrail m")]
    for text in texts:
        words = " ".join(ALNUM_WORD.findall(text)).encode()
        plain = {i for i, (_, p) in enumerate(scanner.rules) if p.search(words)}
        gated = {i for _, which in scanner.automaton.iter(words.decode("latin-1")) for i in which}
        assert plain <= gated


SPDX = """agpl AGPL-3.0-only|lgpl LGPL-2.1-or-later|gfdl GFDL-1.3-only|gpl GPL-3.0-or-later|apache Apache-2.0|mit MIT
bsd-2-clause BSD-2-Clause|bsd-3-clause BSD-3-Clause|bsd-4-clause BSD-4-Clause|0bsd 0BSD|bsd BSD|mpl MPL-2.0|epl EPL-2.0|edl EDL-1.0
cddl CDDL-1.0|cpl CPL-1.0|eupl EUPL-1.2|isc ISC|zlib Zlib|bsl BSL-1.0|artistic Artistic-2.0|psf PSF-2.0|wtfpl WTFPL
unlicense Unlicense|cc0 CC0-1.0|cc-by-nc-nd CC-BY-NC-ND-4.0|cc-by-nc-sa CC-BY-NC-SA-4.0|cc-by-nc CC-BY-NC-4.0
cc-by-nd CC-BY-ND-4.0|cc-by-sa CC-BY-SA-4.0|cc-by CC-BY-4.0|odbl ODbL-1.0|odc-by ODC-By-1.0|ofl OFL-1.1|postgresql PostgreSQL
openssl OpenSSL|php PHP-3.01|ruby Ruby|vim Vim|ms-pl MS-PL|ms-rl MS-RL|upl UPL-1.0|osl OSL-3.0|afl AFL-3.0|sspl SSPL-1.0
busl BUSL-1.1|elastic Elastic-2.0|llama llama3.1|openrail OpenRAIL-M|public-domain CC-PDDC|ncsa NCSA|apsl APSL-2.0
cecill CECILL-B|ecl ECL-2.0|efl EFL-2.0|ipl IPL-1.0|lppl LPPL-1.3c|mulanpsl MulanPSL-2.0|npl NPL-1.1|qpl QPL-1.0|rpl RPL-1.5
sissl SISSL|sleepycat Sleepycat|spl SPL-1.0|w3c W3C|beerware Beerware|blueoak BlueOak-1.0.0|hpnd HPND|curl curl|icu ICU
unicode Unicode-DFS-2016|libpng libpng-2.0|ijg IJG|tcl TCL|ftl FTL|oldap OLDAP-2.8|pddl PDDL-1.0|cdla CDLA-Permissive-2.0
zpl ZPL-2.1|miros MirOS|json JSON|rail BigScience-BLOOM-RAIL-1.0"""


def test_identifiers_and_abbreviations():
    scanner = licenses.Scanner(licenses.rules())
    labels = lambda text: licenses.scan(text.encode(), scanner, {})[5]
    pairs = [p.split() for p in SPDX.replace("\n", "|").split("|")]
    assert {label for label, _ in pairs} == {label for label, *_ in licenses.LICENCES}
    for label, name in pairs:
        for text in (f"// SPDX-License-Identifier: {name}", f"This is released under {name}.", f"It is licensed under the {name} license"):
            assert labels(text) == label, text
    for label, text in (
        ("gpl", "licensed under the GPLv3"), ("mit", "released under MIT"), ("apache", "under the terms of the Apache 2.0 license"),
        ("gpl", "governed by the GNU GPL v2 or later"), ("apache,mit", "SPDX-License-Identifier: MIT OR Apache-2.0"),
        ("bsd-3-clause,gpl,isc", "SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note) OR BSD-3-Clause OR ISC"),
        ("apache", "You may not use this file except in compliance with the License."), ("gpl", "see the GPL"),
    ):
        assert labels(text) == label, text
    for text in ("mit", "the MIT press", "the Apache helicopter", "see the ruby documentation", "permit limit curl vim", "BSD users, GPL code"):
        assert labels(text) == "", text


def test_a_long_text_of_finds_takes_time_in_proportion():
    scanner = licenses.Scanner(licenses.rules())
    text, seconds = b"mit license x ", []
    for n in (20_000, 80_000):
        start = time.perf_counter()
        found = licenses.scan(text * n, scanner)
        seconds.append(time.perf_counter() - start)
        assert found[:4] == (3 * n, n, 0, 3 * (n - 1))
    assert seconds[1] < 8 * seconds[0]


def test_a_language_of_long_texts_is_learned_and_orders_are_checked(spark):
    rows = [(i, "the quick brown fox " * 5, "en") for i in range(5)]
    rows += [(10 + i, f"der schnelle braune fuchs {i} " * (40 + i), "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.learn(docs, langid.Settings(most_bytes=500))
    assert model.languages == ["de", "en"]
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}[12] == "de"
    with pytest.raises(ValueError, match="contexts"):
        langid.Settings(order=4)
