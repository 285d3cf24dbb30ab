"""Prefix trie, Merkle manifest and language identification against brute force, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_corpus_operators import none, odd, odd_rows  # noqa: F401  (fixtures)

from termloom.llm import common, language, merkle, prefix_trie
from termloom.llm.common import running_before


@pytest.fixture
def many_tasks(spark):
    """Small tables are then still dealt over several tasks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


# 11 Prefix trie


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ending[tuple(rebuilt)].append(c)
    out = []
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(len(o) > len(k) and o[: len(k)] == k for o in below)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(map(str, sorted(ending.get(key, []))))
        parent = min(members[key[:-1]]) if key else None
        out.append(
            (min(convs), len(key), parent, len(convs), len(children), len(leaves), saved,
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def trie_rows(spark, rows):
    nodes, _ = prefix_trie.trie(spark.createDataFrame(rows, TURNS))
    return sorted((tuple(row[c] for c in TRIE) for row in nodes.collect()), key=repr)


def conversations(seed=3, count=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), count):
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["a", "b", "é", "longer"])))
    # Copies, and turns out of order, unnumbered, equal, empty or of no conversation.
    for c in (300, 305, 310, 311, 312):
        rows += [(c, t, "user", "same") for t in range(4)]
    rows += [(400, None, "user", "z"), (400, None, None, None), (400, 7, "bot", ""), (400, 7, "bot", "")]
    rows += [(None, 1, "user", "nobody"), (401, 2, "x", "y"), (401, 1, "x", "w")]
    rng.shuffle(rows)
    return rows


def test_trie_matches_brute_force(spark):
    rows = conversations()
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_a_conversation_over_many_tasks(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = conversations(5, 30) + [(55, t, "user", f"{t % 3}") for t in range(150)]
    rows += [(57, t, "user", f"{t % 3}") for t in range(140)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_starts_anew_when_fingerprints_collide(spark, monkeypatch):
    real = prefix_trie.elements
    # With the first seed all turns have one element, with the second they depend on the role.
    def few(roles, texts, seed):
        if seed == 1:
            return np.ones((len(texts), 3), np.int64)
        return real(roles, [""] * len(texts) if seed == 2 else texts, seed)

    monkeypatch.setattr(prefix_trie, "elements", few)
    rows = conversations(7, 20)
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_refers_to_turns(spark):
    rows = [(0, 1, "u", "hello"), (0, 2, "b", "there"), (5, 1, "u", "hello")]
    nodes, turns = prefix_trie.trie(spark.createDataFrame(rows, TURNS))
    met = nodes.join(turns.select("ref", "text"), nodes.turn_ref == turns.ref)
    got = {(r["depth"], r["text"], r["n_convs"]) for r in met.collect()}
    assert got >= {(1, "hello", 2), (2, "there", 1)}


def test_trie_odd_tables(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "a", "b")]) == []
    more = spark.createDataFrame(
        [(4, 1, "u", "t", 9, "x", 3, 1)],
        TURNS + ", depth long, h string, ref long, task long",
    )
    nodes, _ = prefix_trie.trie(more)
    assert sorted((r["conv_id"], r["depth"]) for r in nodes.collect())[0] == (4, 0)


def test_running_sums_over_pieces(spark):
    rows = [("a", i, i) for i in range(100)] + [("b", 40, 5)]
    found = running_before(spark.createDataFrame(rows, "g string, o long, v long"), "g", "o", "v", 8)
    assert {(r["g"], r["o"]): r["before"] for r in found.collect()} == {
        (g, o): sum(v for h, p, v in rows if h == g and p < o) for g, o, _ in rows
    }


# 12 Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """The top, and each leaf's siblings as (left, right)."""
    steps, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(own):
            run = range(at // 3 * 3, min(len(nodes), at // 3 * 3 + 3))
            steps[leaf].append(
                ("".join(nodes[i] for i in run if i < at), "".join(nodes[i] for i in run if i > at))
            )
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        own = [at // 3 for at in own]
    return nodes[0], steps


def brute_manifest(rows):
    """From (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
        return sha("".join(values))

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = brute_tree([leaf(r) for r in sources[s]])
    root, upper = brute_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, upper):
        subroot, steps = trees[s]
        for row, own in zip(sources[s], steps):
            all_steps, changed = own + above, row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].replace("\n", ""))
            folded = leaf(changed)
            for left, right in all_steps:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in all_steps))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


LEAF = "doc_id long, source string, lang string, n_chars long, text string"
MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(docs, levels=merkle.HEIGHT):
    found = merkle.manifest(docs, merkle.without_newlines(), levels).collect()
    return sorted((tuple(row[c] for c in MANIFEST) for row in found), key=repr)


def manifest_texts():
    rng = random.Random(11)
    rows = [
        (i, rng.choice(["hot", "hot", "hot", "b", "é", "", None]), rng.choice(["en", None]),
         rng.choice([3, None]), rng.choice(["a\nb", "plain", "", None, "ü\n\n"]))
        for i in rng.sample(range(500), 150)
    ]
    return rows + [(None, "hot", "en", 1, "x\ny"), (7777, "one", "en", 1, "x"), rows[0], rows[0]]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_matches_brute_force(spark, levels):
    rows = manifest_texts()
    assert manifest_rows(spark.createDataFrame(rows, LEAF), levels) == brute_manifest(rows)


def test_manifest_over_many_tasks(spark, many_tasks):
    rows = manifest_texts()
    assert manifest_rows(spark.createDataFrame(rows, LEAF), 2) == brute_manifest(rows)


def test_manifest_odd_rows(spark, odd, none):  # noqa: F811
    rows = [(i, s, lang, n, t) for i, t, lang, s, n, *_ in odd_rows()]
    assert manifest_rows(odd) == brute_manifest(rows)
    assert manifest_rows(none) == []
    one = [(3, None, None, None, None)]
    assert manifest_rows(spark.createDataFrame(one, LEAF)) == brute_manifest(one)


def test_frontier_is_the_smallest_set():
    rng = random.Random(2)
    for size in (1, 2, 3, 4, 10, 28, 100):
        nodes = [sha(str(i)) for i in range(size)]
        top, steps = brute_tree(nodes)
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append(merkle.parents(levels[-1]))
        for _ in range(10):
            first = rng.randrange(size)
            end = rng.randrange(first, size) + 1
            wanted = merkle.frontier(np.arange(first, end), size)
            fetched = {(n, i): levels[n][i] for n, i in wanted}
            beside, found = merkle.siblings(first, nodes[first:end], size, fetched)
            assert found == top
            assert [merkle.path(i, beside) for i in range(first, end)] == steps[first:end]
            # Nothing asked for covers a given leaf, and nothing is asked for twice.
            covered = [set(range(i * 3**n, (i + 1) * 3**n)) for n, i in wanted]
            assert not any(c & set(range(first, end)) for c in covered)
            assert sum(map(len, covered)) == len(set().union(*covered))


# 13 Language


def bucket(gram):
    mask = (1 << 64) - 1
    codes = [ord(c) * 0x9E3779B97F4A7C15 & mask for c in gram]
    rolled = codes[0]
    for code in codes[1:]:
        rolled = (rolled * 0xD6E8FEB86659FD93 + code) & mask
    found = ((rolled ^ (rolled >> 32)) * 0xFF51AFD7ED558CCD + len(gram)) & mask
    return found >> (64 - language.BUCKET_BITS)


def plain_buckets(text):
    found, word = Counter(), ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            word = f" {word} "
            for n in language.ORDERS:
                found.update(bucket(word[i : i + n]) for i in range(len(word) - n + 1))
            word = ""
    return found


def test_ngrams_match_plain_extraction(monkeypatch):
    texts = [
        "Hello, wörld! a bc 12x", "", "  ", "a", "12 34", "日本語 テ x-y", "İstanbul ΣΑΣ", "\ud800 lone", "z" * 50,
        "it's\n\nfine  _now_",
    ]
    monkeypatch.setattr(common, "PIECE", 12)
    found = [Counter() for _ in texts]
    for rows, parts in common.sub_batches(texts):
        for buckets, of in language.ngrams(rows, parts):
            assert (np.diff(of) >= 0).all()
            for b, row in zip(buckets.tolist(), of.tolist()):
                found[row][b] += 1
    # A run longer than a piece is cut; all others are whole.
    for i, text in enumerate(texts):
        if not text.startswith(("z", "\ud800")):
            assert found[i] == plain_buckets(text), text
    assert found[8] and found[7]


def test_word_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(common, "PIECE", 30)
    monkeypatch.setattr(common, "SUB_BATCH", 50)
    rng = random.Random(4)
    texts = [
        " ".join("".join(rng.choices("abcüß日1_", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 40)))
        for _ in range(60)
    ]
    texts += ["", None, "--", "İx ΣΑΣ a_b", "Ab aB ab", "\ud800 x"]
    hashes = common.word_hashes(texts)
    words = [common.words(text) for text in texts]
    assert [len(h) for h in hashes] == [len(w) for w in words]
    known = defaultdict(set)
    for own, found in zip(words, hashes):
        for word, value in zip(own, found.tolist()):
            known[word].add(value)
    assert all(len(values) == 1 for values in known.values())
    assert len(set.union(*known.values())) == len(known)


def brute_language(train, text):
    counts, priors = defaultdict(Counter), Counter()
    for t, lang in train:
        counts[lang].update(plain_buckets(t))
        priors[lang] += 1
    found = plain_buckets(text)
    if not found:
        return "und", 0.0
    logs = {}
    for lang in sorted(counts):
        total = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
        logs[lang] = np.log(priors[lang] / len(train)) + sum(
            n * np.log((counts[lang][b] + language.SMOOTHING) / total) for b, n in found.items()
        )
    best = max(logs, key=lambda x: logs[x])
    return best, 1 / sum(np.exp(v - logs[best]) for v in logs.values())


def test_language_matches_brute_force(spark):
    train = [
        ("the cat sat on the mat", "en"), ("where is the house", "en"), ("der hund und die katze", "de"),
        ("wo ist das haus", "de"), ("ou est la maison", "fr"), (None, "fr"), ("ignored words", None),
    ]
    model = language.train(spark.createDataFrame(train, "text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    texts = ["the dog", "die maus", "la", "", None, "123 --", "house and katze", "é", "the " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    known = [(t or "", lang) for t, lang in train if lang]
    for i, text in enumerate(texts):
        lang, score = brute_language(known, text or "")
        assert got[i]["lang_pred"] == lang
        assert got[i]["score"] == pytest.approx(score, abs=1e-3)


def test_language_odd_rows(spark, odd, none):  # noqa: F811
    model = language.train(odd)
    found = language.predict(odd, model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(row[0] for row in odd_rows())
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert {r["lang_pred"] for r in found if r["doc_id"] == 12} == {"en"}
    untaught = language.train(none)
    assert untaught.languages == []
    assert {(r["lang_pred"], r["score"]) for r in language.predict(odd, untaught).collect()} == {("und", 0.0)}
    assert language.predict(none, model).count() == 0


def test_language_keeps_the_most_frequent_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [("aaa", "x")] * 3 + [("bbb", "y")] * 2 + [("ccc", "z")] * 2
    assert language.train(spark.createDataFrame(rows, "text string, lang string")).languages == ["x", "y"]
