"""The prefix trie, token counts and whitening against plain loops and libraries."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from evenkeel.llm import eigen, prefix_trie, token_counts, whitening
from evenkeel.llm.perfect_hash import PerfectHash

WORDS = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
BYTES = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# The trie


def rebuilt(rows):
    own = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, listed in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + listed[h:]
    return made


def brute_trie(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(n) == len(node) + 1 for n in below),
                len(leaves),
                sum((len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0) for n in below),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations():
    draw = random.Random(5)
    rows = []
    for c in [*range(-12, 40), 2**62, 1000003]:
        if c in (5, 20):
            continue  # some first conversations are absent
        for turn in range(draw.randint(1, 12)):
            text = draw.choice(["hello", "né", "", None])
            rows.append((c, turn if turn else None, draw.choice(["user", None, ""]), text, "x"))
    rows += [(50, 0, "user", "long " * 40_000, "x"), (51, 0, "user", "long " * 40_000, "x")]
    rows += [(60, 1, "a", "same", "x")] * 3  # repeated rows are turns of their own
    rows += [(None, 1, "user", "no conversation", "x")]
    return rows


KIND = "conv_id long, turn long, role string, text string, depth string"


@pytest.mark.parametrize("least", [1, 30, 4096])
def test_trie_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(prefix_trie, "LEAST_ROWS", least)
    monkeypatch.setattr(prefix_trie, "GATHERED", 16)
    monkeypatch.setattr(prefix_trie, "_LISTED", 5)
    rows = conversations()
    numbered = prefix_trie.turns(spark.createDataFrame(rows, KIND).repartition(5))
    got = found(prefix_trie.prefix_trie(prefix_trie.spliced(numbered)), *NODE)
    assert got == brute_trie(rebuilt(rows))


def test_trie_of_plain_conversations(spark):
    rows = [(c, t, "u", text, "x") for c, listed in {1: "ab", 2: "abc", 3: "ab", 4: "x"}.items() for t, text in enumerate(listed)]
    numbered = prefix_trie.turns(spark.createDataFrame(rows, KIND))
    paths = {1: "ab", 2: "abc", 3: "ab", 4: "x"}
    paths = {c: [("u", text) for text in listed] for c, listed in paths.items()}
    assert found(prefix_trie.prefix_trie(prefix_trie.plain(numbered)), *NODE) == brute_trie(paths)


def test_trie_of_nothing(spark):
    numbered = prefix_trie.turns(spark.createDataFrame([(None, 1, "u", "t", "x")], KIND))
    assert prefix_trie.prefix_trie(prefix_trie.spliced(numbered)).count() == 0


def test_tied_turns_have_one_order(spark):
    rows = [(7, 1, "u", t, "x") for t in "abcdef"] + [(8, 1, "u", t, "x") for t in "fedcba"]
    numbered = prefix_trie.turns(spark.createDataFrame(rows, KIND).repartition(4))
    nodes = prefix_trie.prefix_trie(prefix_trie.plain(numbered))
    assert nodes.count() == 7 and {r.n_convs for r in nodes.collect()} == {2}


def test_perfect_hash():
    draw = np.random.default_rng(2)
    for size in (0, 1, 2, 1000):
        high, low = draw.integers(0, 2**63, (2, size), dtype=np.uint64)
        table = PerfectHash(high, low)
        assert sorted(table.slots(high, low)) == list(range(size))
        assert (table.slots(high + np.uint64(1), low) == -1).all()
    with pytest.raises(ValueError):
        PerfectHash(np.array([3, 3], dtype=np.uint64), np.array([4, 4], dtype=np.uint64))


# Token counts


def tricky():
    draw = random.Random(1)
    letters = "aB é́ñ中🙂1٣'  \x1c\t\n.,!-_ſİΣ"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(200)]
    texts += ["", None, " \n ", "x<|endoftext|>y <|startoftext|> <|endoftext|", "don't I'LL we've 's", "z" * 5000]
    texts += ["word another " * 30_000, "same same", "same same"]
    return texts


@pytest.mark.parametrize(
    "definition, cutter",
    [(WORDS, token_counts.Words), (WORDS, token_counts.PreTokens), (BYTES, token_counts.PreTokens)],
)
def test_token_counts_equal_the_library(spark, monkeypatch, definition, cutter):
    monkeypatch.setattr(token_counts, "BLOCK_ROWS", 16)
    monkeypatch.setattr(token_counts, "BUCKETS", 5)
    monkeypatch.setattr(token_counts, "KNOWN", 30)
    texts = tricky()
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)] + [(3, "repeated id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    tokenizer = Tokenizer.from_str(definition)
    expected = []
    for i, text, _ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 20))
    got = token_counts.token_counts(docs, definition, limit=20, cutter=cutter)
    assert found(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def test_token_counts_of_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tokenizer = Tokenizer.from_str(WORDS)
    expected = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert dict(found(token_counts.token_counts(docs, WORDS), "doc_id", "n_tokens")) == expected
    assert token_counts.token_counts(docs.limit(0), WORDS).count() == 0


def test_words_need_a_tokenizer_without_spaces():
    with pytest.raises(ValueError, match="white space"):
        token_counts.Words(BYTES)


# Whitening


VECTORS = "vec_id long, embedding array<float>, n string"


def check_whitening(rows, got, components=8):
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    x = np.floor(1024 * np.array([v for _, v in vectors])).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    z = (n * x - total) / n
    covariance = z.T @ z / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    count = len(values)
    assert len(got) == n * count
    w = z @ axes / np.sqrt(values)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r)
    deviations = ((n * x.astype(object) - total.astype(object)) ** 2).sum(axis=1)
    signs = np.zeros(count)
    for (i, _), d, row in zip(vectors, deviations, w):
        for k in range(count):
            r = by_row[(i, int(d))][k + 1][0]
            assert r.n == n
            assert abs(r.explained - values[k] / np.trace(covariance)) < 1e-9
            signs[k] = signs[k] or np.sign(r.whitened * row[k])
            assert abs(r.whitened - signs[k] * row[k]) < 1e-7
            assert r.identity_error < 1e-9


def test_whitening_equals_numpy(spark):
    draw = np.random.default_rng(7)
    mix = draw.normal(size=(12, 12))
    rows = [(i, (draw.normal(size=12) @ mix).tolist()) for i in range(60)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (90, rows[5][1])]
    odd = [(100, None), (101, []), (102, [None] * 12), (103, [float("nan")] * 12), (104, [float("inf")] * 12), (105, [1.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows + odd], VECTORS).repartition(4)
    check_whitening(rows, whitening.whitened(table).collect())


def test_whitening_of_few_vectors(spark):
    def got(rows):
        return whitening.whitened(spark.createDataFrame([(*r, "x") for r in rows], VECTORS)).collect()

    assert got([]) == [] and got([(1, None)]) == []
    one = got([(1, [1.0, 2.0])])
    assert [(r.component, r.n, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, None, 0.0, None),
        (2, 1, None, 0.0, None),
    ]
    # Two different vectors vary in one direction only.
    two = got([(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])])
    assert [r.whitened is None for r in sorted(two, key=lambda r: (r.vec_id, r.component))] == [False, True, True] * 2
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in two if r.component == 1)
    with pytest.raises(PythonException, match="no exact sums"):
        got([(1, [1e30, 2.0]), (2, [0.0, 2.0])])


@pytest.mark.parametrize("n, large", [(2**33, 2**25), (2**36, 2**26)])
def test_exact_sums_beyond_64_bits(n, large):
    fitted = whitening.Whitening(n, [2**50, -(2**50)], np.empty(0), 0.0, np.empty((2, 0)))
    apart = fitted.apart(np.array([[large, 5]]))
    assert apart.tolist() == [[n * large - 2**50, 5 * n + 2**50]]
    assert int(whitening._squares(apart)[0].as_py()) == sum(int(v) ** 2 for v in apart[0])


@pytest.mark.parametrize("size", [1, 2, 3, 17, 60])
def test_eigenpairs(size):
    draw = np.random.default_rng(size)
    square = draw.normal(size=(size, size))
    turn, _ = np.linalg.qr(square)
    for matrix in (
        square @ square.T,
        np.eye(size) * 3,
        np.zeros((size, size)),
        turn @ np.diag(np.repeat(np.arange(1.0, size + 1), 3)[:size]) @ turn.T,
    ):
        values, rows = eigen.leading(matrix, 8)
        scale = max(1.0, np.abs(matrix).max())
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:8], atol=1e-12 * scale)
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)
        assert np.allclose(matrix @ rows.T, rows.T * values, atol=1e-11 * scale)
