"""The corpus operators on small tables, against brute force, and on odd rows."""

import hashlib
import itertools
import math
import pickle
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm import (
    decontamination,
    exact_dedup,
    licences,
    near_dedup,
    packing,
    pii,
    queries,
    secrets,
    token_counts,
    toxicity,
    warc,
)
from termloom.llm.common import ROW, word_hashes
from termloom.llm.components import components

LONG_KEY = "aB3_-" * 30
LICENCE_FILES = Path("/usr/share/common-licenses")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, "
    "score double, keep string, digest string, bin int, kind string, n long, words string"
)
LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))


def vocabulary(rng, size=400):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(size)]


def odd_rows():
    rng = random.Random(5)
    words = vocabulary(rng)
    plain = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    texts = [
        (1, None), (2, ""), (3, "   \n"), (None, plain[0]), (5, plain[0]), (5, plain[0]),
        (5, plain[1]), (6, plain[2].upper() + "!"), (7, plain[2]), (8, "one two"), (9, "One, two"),
        (None, None), (10, LONG), (11, "a@b.co and 1.2.3.4"), (12, "日本語のテキスト <|endoftext|>"),
        (13, plain[3]), (14, plain[3] + " extra"), (15, "Released under the MIT License."),
    ]
    return [(i, t, "en", "s", 1, 0.5, "k", "d", 3, "x", 7, "w") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    return [(row[0], row[1] or "") for row in odd_rows()]


def stable(pairs):
    return Counter(map(repr, pairs))


# 1 Decontamination


def test_decontamination_tolerates_substitutions(spark):
    rng = random.Random(1)
    words = vocabulary(rng, 3000)
    item = rng.choices(words, k=40)
    changed = [w if i % 7 else "zzz" for i, w in enumerate(item)]
    noise = lambda n: " ".join(rng.choices(words, k=n))
    docs = [
        (1, f"{noise(50)} {' '.join(item)} {noise(9)}"),
        (2, f"{noise(5)}, {', '.join(changed).upper()}."),
        (3, noise(300)),
        (4, " ".join(item[:8])),
        (5, " ".join(item[10:26]) + noise(30)),
        (6, None),
        (7, "Five short words only here and more"),
        (None, " ".join(item)),
    ]
    bench = [(9, " ".join(item)), (9, " ".join(item)), (8, "five short words only here"), (7, "tiny one"), (6, None)]
    found = decontamination.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string"),
    )
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(1, 9), (2, 9), (5, 9), (7, 8), (None, 9)}
    starts = {r.doc_id: r.start for r in found.filter("item_id = 9").collect()}
    assert starts[1] == 50 and starts[5] == -10


@pytest.mark.parametrize("size", range(decontamination.LEAST, decontamination.WINDOW + 1))
def test_masks_meet_every_accepted_substitution(size):
    masks = decontamination.MASKS if size >= decontamination.LONG else decontamination.SHORT_MASKS
    seeds = [
        {at + i for i, c in enumerate(mask) if c == "1"} for mask in masks for at in range(size - len(mask) + 1)
    ]
    substituted = size - math.ceil(decontamination.AGREEING * size)
    for lost in itertools.combinations(range(size), substituted):
        assert any(not seed & set(lost) for seed in seeds), lost


def test_decontamination_of_short_items(spark):
    rng = random.Random(8)
    words = vocabulary(rng, 2000)
    bench = [(i, " ".join(rng.choices(words, k=5 + i % 6))) for i in range(12)]
    docs, want = [], set()
    for i, text in bench:
        for j in range(len(text.split())):
            changed = text.split()
            changed[j] = "zzz"
            docs.append((100 * i + j, f"{' '.join(rng.choices(words, k=5))} {' '.join(changed)} x"))
            want.add((100 * i + j, i))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    schema = "item_id long, text string"
    found = decontamination.overlaps(frame, spark.createDataFrame(bench, schema)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    # A long item beside them changes nothing.
    more = [*bench, (99, " ".join(rng.choices(words, k=30)))]
    found = decontamination.overlaps(frame, spark.createDataFrame(more, schema)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_decontamination_blocks_and_odd_rows(spark, odd, none, monkeypatch):
    bench = spark.createDataFrame([(i, f"{i} alpha beta gamma delta epsilon zeta eta theta") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"say {i} alpha beta gamma delta epsilon zeta eta theta") for i in range(30)], "doc_id long, text string")
    whole = decontamination.overlaps(docs, bench).select("doc_id", "item_id", "agreeing").collect()
    monkeypatch.setattr(decontamination, "BLOCK_SEEDS", 100)
    blocks = decontamination.overlaps(docs, bench).select("doc_id", "item_id", "agreeing").collect()
    assert len(whole) == 900 and set(whole) == set(blocks)
    assert decontamination.overlaps(odd, bench).count() == 0
    assert decontamination.clean(odd, bench).columns == odd.columns
    assert decontamination.clean(odd, bench).count() == odd.count()
    assert decontamination.clean(none, bench).count() == 0
    assert decontamination.overlaps(docs, bench.limit(0)).count() == 0


def test_decontamination_of_a_long_document_full_of_hits(spark):
    # Rows of hits with all words of the document would take some 29 GB.
    rng = random.Random(4)
    text = " ".join(rng.choices(vocabulary(rng, 3000), k=40))
    docs = spark.createDataFrame([(1, " ".join([text] * 500)), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, text) for i in range(20)], "item_id long, text string")
    found = decontamination.overlaps(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.start, r.agreeing, r.covered) for r in found} == {
        (1, i, 499 * 40, decontamination.WINDOW, 1.0) for i in range(20)
    }
    assert len(found) == 20
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [2]


def test_decontamination_in_pieces_and_without_broadcasts(spark, monkeypatch):
    rng = random.Random(5)
    words = vocabulary(rng, 2000)
    bench = [(i % 25, " ".join(rng.choices(words, k=6 + i))) for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=i) + text.split()[i % 3 : 40] + ["x"] * (i % 5))) for i, (_, text) in enumerate(bench)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(bench, "item_id long, text string")
    whole = stable(decontamination.overlaps(docs, bench).drop(*ROW).collect())
    assert len(whole) >= 25
    monkeypatch.setattr(decontamination, "PIECE", 8)
    monkeypatch.setattr(decontamination, "ITEM_BYTES", -1)
    monkeypatch.setattr(decontamination, "fits_broadcast", lambda frame: False)
    assert stable(decontamination.overlaps(docs, bench).drop(*ROW).collect()) == whole


# 2 Personal data


def test_pii_base_spans_match_plain_patterns():
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4785380592391139", "4785 3805-9239 1139",
             "+1 (988) 555-2485", "+1", "..", "-", "a@b@c.d.e", "0001.2.3.004", "12345", "+49 30 1234567.", "é", " "]
    card, ip = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: re.sub("[^0-9]", "", s)
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        want = [(0, *m.span()) for m in email.finditer(text)]
        want += [(1, *m.span()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        want += [(2, *m.span()) for m in card.finditer(text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
        want += [(3, *m.span()) for m in phone.finditer(text) if 9 <= len(digits(m[0])) <= 15]
        assert pii.base_spans(text) == want, text


def pii_field(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        number = f"{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        rows.append((i, f"call +1 (555) {number} or mail u{i}@mail.example.com about item {i} of 12"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return pii.train(docs)


def test_pii_labels_repeats_like_their_first_mention(spark):
    field = pii_field(spark)
    text = "call +1 (555) 234-8812 today. " + "filler words here " * 40 + "again (555) 234-8812 or item 12"
    spans = pii.base_spans(text)
    more = pii.further_spans(text, spans, field)
    assert [text[s:e] for k, s, e in more if k == 3] and all(s > 100 for _, s, _ in more)
    assert "234-8812" in " ".join(text[s:e] for _, s, e in more)
    assert not any("12" == text[s:e] for _, s, e in more)
    assert pii.further_spans("item 12 of 13", [], field) == []


def test_pii_marginals_agree_with_enumeration(spark):
    field = pii_field(spark)
    words, places = ["555-2485", "x9", "555-2485"], [(0, 8), (9, 11), (500, 508)]
    got = field.marginals(places, words, np.array([4, -1, -1]))
    k = len(pii.LABELS)
    unary = [field.unary[pii.shape(w)].sum(axis=0) for w in words]
    total = np.zeros((3, k))
    for b in range(k):
        for c in range(k):
            weight = np.exp(unary[1][b] + unary[2][c] + field.chain[4, b] + field.skip[4, c])
            total[0, 4] += weight
            total[1, b] += weight
            total[2, c] += weight
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_pii_field_runs_without_a_base_span():
    unary = np.zeros((pii.FEATURES, len(pii.LABELS)))
    unary[0, 4] = 9.0
    field = pii.Field(unary, np.zeros((5, 5)), np.zeros((5, 5)))
    assert pii.further_spans("call 555-2485 now", [], field) == [(3, 5, 13)]
    assert pii.further_spans("no marks", [], field) == []


def test_pii_odd_rows(spark, odd, none, texts):
    field = pii.train(odd)
    rows = pii.scan(odd, field).collect()
    assert len(rows) == len(texts)
    assert stable((r.doc_id, r.n_email, r.n_ip) for r in rows) == stable(
        (i, t.count("@"), t.count("1.2.3.4")) for i, t in texts
    )
    assert pii.scan(none, pii.train(none)).count() == 0


# 3 Packing


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert stable(want) == stable((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for sequence in places.values():
        end = 0
        for offset, length in sorted(sequence):
            assert offset == end
            end += length
        assert end <= 2048
    return len(places), sum(r.length for r in rows)


def test_packing_odd_rows(spark, odd, none, texts):
    definition = queries.tokenizer("word_bpe_49k.json")
    check_packing(packing.pack(odd, definition).collect(), texts)
    assert packing.pack(none, definition).count() == 0


def test_packing_merges_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BINS", 5)
    rng = random.Random(6)
    texts = [(i, "the " * int(rng.expovariate(1 / 700))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(20)
    rows = packing.pack(docs, queries.tokenizer("word_bpe_49k.json")).collect()
    used, total = check_packing(rows, texts)
    assert used <= 1.05 * total / 2048 + 1


def test_best_fit_takes_the_fullest_bin():
    bins, offsets = packing.best_fit(np.array([5, 4, 3, 2, 6]), 10)
    assert bins.tolist() == [1, 0, 1, 1, 0] and offsets.tolist() == [0, 6, 5, 8, 0]


# 4 Licences


def test_licences(spark, odd, none, texts):
    mit = dict(licences.KNOWN[:1])["MIT"]
    varied = mit.replace("<year> <copyright holders>", "2021 Somebody").replace("sublicense", "sub-licence").upper()
    docs = [
        (1, varied), (2, mit + " and more"), (3, "x\nReleased under the MIT licence!\ny"),
        (4, "  LICENSED under CC BY-NC 4.0  "), (5, None), (6, "!!"), (None, "Released under the MIT License."),
    ]
    rows = licences.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r.doc_id: (r.licence_id, r.line_licences, r.n_lines) for r in rows}
    assert got == {
        1: ("MIT", "", 0), 2: (None, "", 0), 3: (None, "MIT", 1), 4: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", 1),
        5: (None, "", 0), 6: (None, "", 0), None: ("MIT", "MIT", 1),
    }
    assert licences.scan(odd).count() == len(texts)
    assert licences.scan(none).count() == 0


def test_licences_titles_headers_and_notices(spark):
    texts = dict(licences.KNOWN)
    body = dict(reversed(licences.KNOWN))["MIT"].partition("\n")[2]
    docs = {
        "The MIT License (MIT)\n" + body: "MIT",
        body.replace("(c) <year> <copyright holders>", "The Authors"): "MIT",
        'BSD 3-Clause "New" or "Revised" License\n\nCopyright 2020, X\n' + texts["BSD-3-Clause"]: "BSD-3-Clause",
        texts["Unlicense"].upper(): "Unlicense",
        texts["AGPL-3.0"].replace("see <", "see "): "AGPL-3.0",
        "// SPDX-License-Identifier: BSL-1.0": "BSL-1.0",
        "This project is licensed under the terms of the GNU Affero General Public Licence, version 3": "AGPL-3.0",
        "Available under Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "MIT License": None,
        "not a licence": None,
    }
    rows = licences.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.licence_id for r in rows} == dict(enumerate(docs.values()))


def test_licences_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Copyright 2024 Me.\n\nDo as you like,\nbut do it well.")
    (tmp_path / "Other").write_text("Nothing is allowed.")
    known = licences.read_licences(spark, str(tmp_path))
    docs = spark.createDataFrame([(1, "Do as you like but do it well"), (2, "MIT")], "doc_id long, text string")
    got = {r.doc_id: r.licence_id for r in licences.scan(docs, known).collect()}
    assert got == {1: "Own-1.0", 2: None}


@pytest.mark.skipif(not LICENCE_FILES.is_dir(), reason="no licence files here")
def test_licence_digests_are_those_of_the_files(spark):
    held = dict(licences.DIGESTS)
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "MPL-2.0": "MPL-2.0"}
    # Case and indentation do not matter.
    rows = [(i, (LICENCE_FILES / name).read_text().upper().replace("  ", " ")) for i, name in files.items()]
    known = spark.createDataFrame(rows, "licence_id string, text string")
    assert {r.licence_id: r.digest for r in licences.digests_of(known).collect()} == {i: held[i] for i in files}


# 5 Exact deduplication


def check_exact(rows, texts):
    groups = {}
    for doc_id, text in texts:
        groups.setdefault(text, []).append(doc_id)
    best = {t: max(ids, key=lambda i: -1 if i is None else i) for t, ids in groups.items()}
    want = stable((i, best[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)
    assert want == stable((r.doc_id, r.keep["doc_id"], r.group_size, bytes(r.digest).hex()) for r in rows)
    kept = [r for r in rows if (r.keep["_file"], r.keep["_at"]) == (r._file, r._at)]
    assert len(kept) == len(groups)


def test_exact_dedup_odd_rows(spark, odd, none, texts):
    check_exact(exact_dedup.decide(odd).collect(), texts)
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len({t for _, t in texts})
    assert exact_dedup.decide(none).count() == 0


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    table, store = f"{tmp_path}/docs", f"{tmp_path}/store"
    first = [(i, f"text {i % 5}") for i in range(20)]
    second = [(i, f"text {i % 7}") for i in range(20, 60)]
    for rows in (first, second):
        spark.createDataFrame(rows, "doc_id long, text string").write.mode("append").parquet(table)
        decided = exact_dedup.decide(spark.read.parquet(table), store)
        check_exact(decided.collect(), first if rows is first else first + second)


def test_exact_dedup_compares_bytes_on_hits(spark, monkeypatch):
    rows = [(i, "same" if i % 2 else "other") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = exact_dedup.arrivals
    monkeypatch.setattr(exact_dedup, "arrivals", lambda placed: plain(placed).withColumn("digest", F.unhex(F.lit("00"))))
    got = {r.doc_id: (r.keep["doc_id"], r.group_size) for r in exact_dedup.decide(docs).collect()}
    assert got == {i: (11 if i % 2 else 10, 6) for i in range(12)}


# 6 WARC


def test_warc_round_trip(spark, tmp_path):
    same = "<html>" + "x" * 200
    pages = [(1, "http://a/ b", same), (2, None, same), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
             (None, "u", same), (6, "u", "é\r\n\r\n\0" * 50), (6, "u", "é\r\n\r\n\0" * 50)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder, manifest = warc.write_archives(docs, str(tmp_path / "archives"))
    rows = warc.read_archives(spark, folder, manifest).collect()
    got = stable((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows)
    size = len(pages[6][2].encode())
    assert got == stable(
        [(1, 206, "response", None), (2, 206, "revisit", 1), (3, 5, "response", None), (4, 5, "response", None),
         (5, 0, "response", None), (None, 206, "revisit", 1), (6, size, "response", None), (6, size, "revisit", 6)]
    )
    assert {r.html for r in rows if r.record_type == "response"} == {same, "short", "", pages[6][2]}
    folder, manifest = warc.write_archives(docs.limit(0))
    assert warc.read_archives(spark, folder, manifest).count() == 0


def test_warc_leading_dictionary_and_damage(spark, tmp_path):
    rng = random.Random(8)
    words = vocabulary(rng)
    pages = [(i, f"http://h/{i}", "<p>" + "</p><p>".join(rng.choices(words, k=120))) for i in range(400)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    folder, manifest = warc.write_archives(docs, str(tmp_path / "archives"))
    file = tmp_path / "archives" / manifest.first()["file"]
    data = file.read_bytes()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    assert data[4:8] != b"\0\0\0\0"
    assert warc.read_archives(spark, folder, manifest).count() == 400
    import io

    frames = list(warc._frames(io.BytesIO(data), "f"))
    assert len(frames) == 400
    for damaged in (data[:-3], data[:-40] + bytes(40)):
        with pytest.raises(ValueError):
            list(warc._frames(io.BytesIO(damaged), "f"))
    fields, block = warc.parse_record(frames[0][1])
    assert fields["warc-type"] == "response" and len(block) == int(fields["content-length"])
    for bad in (frames[0][1][:-1], b"HTTP/1.1\r\n\r\n", frames[0][1].replace(b"Content-Length", b"Content-Other")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


# 7 Secrets


def base_secrets(text):
    names = "password passwd secret token api_?key".split()
    either = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in n) for n in names)
    assign = re.compile(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_base_spans_and_links(spark, odd, none, texts):
    rng = random.Random(9)
    parts = ["token", "=", ":", " ", "abcdef12", "secret", "PassWord", '"', "ab", "AKIA", "ABCDEFGH12345678", "é😀", "0123456789abcdef" * 2, "api_key", "\n"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(400)]
    weak = "https://vault.example.com/v1"
    rows += [
        (1000, f"user: admin1 password = hunter22 at {weak}"),
        (1001, f"see {weak} for more"),
        (1002, f"{weak} " + "far " * 100 + "password=hunter22"),
        (1003, "client_id=abc123 key aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF " + "x"),
        (1004, f"login: bob1 {LONG_KEY} and {weak}/{'p' * 400} " + "so " * 200),
    ]
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        base = base_secrets(text)
        r = found[doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[1] == k for b in base) for k in range(3)], text
        written = ",".join(f"{n}:{s}:{e}" for s, _, n, e in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest(), text
        assert set(written.split(",")) - {""} <= set(r.spans.split(","))
    kinds = lambda i: [s.split(":")[0] for s in found[i].spans.split(",")]
    assert kinds(1000) == ["weak_id", "assign", "endpoint"]
    assert found[1001].spans == "" and kinds(1002) == ["assign"]
    assert sorted(kinds(1003)) == ["weak_id", "weak_secret"]
    # However long, a part is whole.
    end = 12 + len(LONG_KEY)
    assert found[1004].spans == f"weak_id:0:11,weak_secret:12:{end},endpoint:{end + 5}:{end + 406 + len(weak)}"
    assert secrets.scan(odd).count() == len(texts)
    assert secrets.scan(none).count() == 0


# 8 Token counts


def test_token_counts(spark, odd, none, texts, monkeypatch):
    definition = queries.tokenizer("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_str(definition)
    want = stable(
        (i, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in texts
    )
    for head in (token_counts.HEAD, 0):
        monkeypatch.setattr(token_counts, "HEAD", head)
        rows = token_counts.count_tokens(odd, definition).collect()
        assert stable((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert token_counts.count_tokens(none, definition).count() == 0


# 9 Toxicity


@pytest.mark.parametrize("stands_out", [0.0, 2.0, 1e9])
def test_block_max_search_is_exact(monkeypatch, stands_out):
    monkeypatch.setattr(toxicity, "STANDS_OUT", stands_out)
    rng = np.random.default_rng(1)
    dense = rng.random((500, 60)) * (rng.random((500, 60)) < 0.1)
    dense /= np.maximum(np.sqrt((dense**2).sum(axis=1, keepdims=True)), 1e-9)
    rows, columns = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(500, 60, rows, columns, dense[rows, columns])
    index = pickle.loads(pickle.dumps(index))
    terms, weights, starts = index.vectors(3, 470)
    for i, row in enumerate(dense[3:470]):
        own = slice(starts[i], starts[i + 1])
        assert (terms[own] == np.flatnonzero(row)).all() and np.allclose(weights[own], row[row > 0])
    for q in range(40):
        terms = np.flatnonzero(dense[q])
        if len(terms):
            near, cosines = index.nearest(terms, dense[q][terms], 10)
            scores = dense @ dense[q]
            assert np.allclose(np.sort(scores)[::-1][: len(near)], cosines, atol=2e-6)
            assert len(near) == min(10, np.count_nonzero(scores > 0))
            assert np.allclose(scores[near], cosines, atol=2e-6)


def toxic_tables(spark, n=600):
    rng = random.Random(10)
    words = vocabulary(rng)
    bad = ["grobian", "lumpen", "schuft"]
    docs, labels = [], []
    for i in range(n):
        found = rng.choices(words, k=50)
        if i % 5 == 0:
            found[3:5] = rng.sample(bad, 2)
        docs.append((i, " ".join(found)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 1, int(i % 5 == 0)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_learns_and_gives_evidence(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.train(docs, labels.filter("doc_id < 400"))
    rows = toxicity.score(docs, model).collect()
    assert [r.predicted for r in sorted(rows)] == [int(i % 5 == 0) for i in range(600)]
    assert all(0 <= r.score <= 1 for r in rows)
    toxic = next(r for r in rows if r.predicted)
    assert toxic.evidence and all(e["toxic"] == 1 for e in toxic.evidence[:3])
    kept = toxicity.accepted(docs.withColumn("score", F.lit("s")), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 480


def test_toxicity_cosines_are_over_all_words(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", 4)
    rng = random.Random(21)
    vocab = vocabulary(rng, 300)
    texts = [" ".join(rng.choices(vocab, k=rng.randint(5, 40)) + [f"only{i}"]) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(60)], "doc_id long, toxic boolean")
    df = Counter(w for t in texts for w in set(t.split()))

    def vector(text):
        raw = {w: (1 + np.log(n)) * (np.log(121 / (1 + df[w])) + 1) for w, n in Counter(text.split()).items()}
        return {w: x / np.sqrt(sum(y * y for y in raw.values())) for w, x in raw.items()}

    vectors = [vector(t) for t in texts]
    for row in toxicity.score(docs, toxicity.train(docs, labels)).collect():
        own = vectors[row.doc_id]
        dots = sorted((sum(x * v.get(w, 0) for w, x in own.items()) for v in vectors[:60]), reverse=True)
        dots = [d for d in dots[: toxicity.NEIGHBOURS] if d > 0]
        assert np.allclose([e["cosine"] for e in row.evidence], dots, atol=3e-6)


def test_toxicity_odd_rows(spark, odd, none, texts):
    docs, labels = toxic_tables(spark)
    model = toxicity.train(docs, labels)
    assert toxicity.score(odd, model).count() == len(texts)
    assert toxicity.accepted(odd, model).columns == odd.columns
    assert toxicity.score(none, model).count() == 0
    bare = toxicity.train(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, bare).collect()} == {0.0}
    nulls = labels.select("doc_id", "quality", F.lit(None).cast("int").alias("toxic"))
    assert toxicity.train(docs, nulls).share == 0
    unseen = toxicity.train(none, labels)
    assert 0 <= unseen.empty <= 1


# 10 Near-duplicates


def near_rows(seed=11, bases=12, copies=6, length=90):
    rng = random.Random(seed)
    words = vocabulary(rng, 3000)
    rows = []
    for _ in range(bases):
        base = rng.choices(words, k=length)
        for c in range(copies):
            text = list(base)
            for _ in range(c):
                text[rng.randrange(length)] = rng.choice(words)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute_classes(rows, factors):
    vectors = []
    for _, text in rows:
        found, counts = near_dedup.shingles(word_hashes([text])[0])
        weights = near_dedup._weights(found, counts, factors)
        vectors.append((found, weights, float(weights.sum())))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.similarity(vectors[i], vectors[j]) >= near_dedup.SIMILARITY:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_near_dedup_classes(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.classify(docs).collect()
    want = brute_classes(rows, near_dedup.inverse_frequencies(docs))
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.keep == (r.doc_id == r.class_id) for r in got)


def test_near_dedup_large_clusters_meet_in_smaller_groups(spark, monkeypatch):
    rows = near_rows(seed=12, bases=3, copies=60, length=300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows, near_dedup.inverse_frequencies(docs))
    for limit in (25, 12):
        monkeypatch.setattr(near_dedup, "GROUP_NODES", limit)
        got = {r.doc_id: r.class_id for r in near_dedup.classify(docs).collect()}
        equal = sum(got[d] == want[d] for d in want)
        assert equal >= 0.97 * len(want)


def test_near_dedup_hot_band_values_compare_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_NODES", 6)
    # All nodes share one band value and no other: all pairs must meet, each in one group at least.
    rows = [(i, 10, [7, 100 + i]) for i in range(60)]
    nodes = spark.createDataFrame(rows, "node long, size long, keys array<long>")
    groups = near_dedup.groups_of(nodes)
    held = {}
    for row in groups.collect():
        held.setdefault((row.kind, row.id, row.slot), set()).add(row.node)
    met = {(a, b) for group in held.values() for a in group for b in group if a < b}
    assert met == {(a, b) for a in range(60) for b in range(a + 1, 60)}


def test_samples_agree_as_often_as_weights_do():
    rng = np.random.default_rng(2)
    sampler = near_dedup.Sampler(seed=3, samples=600)
    hashes = np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    a, b = rng.random(300) + 0.2, rng.random(300) + 0.2
    b[:240] = a[:240]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = (sampler.draw(hashes, a) == sampler.draw(hashes, b)).mean()
    assert abs(got - want) < 0.06


def test_near_dedup_odd_rows(spark, odd, none, texts):
    got = near_dedup.classify(odd).collect()
    assert len(got) == len(texts)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    # 1, 2, 3 and a null id have no words; 5 and a null id share words; case does not count.
    assert sorted(classes[1], key=str) == [1, 2, 3, None]
    assert sorted(classes[6]) == [6, 7] and sorted(classes[8]) == [8, 9] and sorted(classes[13]) == [13, 14]
    assert Counter(classes[5]) == Counter([5, 5, 5, None])
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.keep for r in got)
    assert near_dedup.classify(none).count() == 0


def test_components(spark):
    rng = random.Random(13)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(50)] + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    want = {x: find(x) for x in parent if find(x) != x}
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0
