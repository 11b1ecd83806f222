"""Pieces, spelling variants and alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from landweave.llm import align, common, pieces, queries, variants

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, ids string, word string, n string, digest string, copies string"
PIECES, BYTES = queries.tokenizer("piece_bpe_32k.model"), queries.tokenizer("byte_bpe_50k.json")

ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "\n\n", "  a   b\t\tc \n d", " " * 15, " " * 16, " " * 17 + "x", " " * 33 + "the", "a" + " " * 49 + "b" + " " * 16, " " * 31 + "\n" + " " * 32,
    "▁▁x ▁", "<s></s><0x0A> <|endoftext|>", "漢字かな😀 é ü ñ", "x" * 300, "the" * 50 + " " + "ing" * 33, "\x01 q", "ﬁ ½ ‍", "==" * 51 + "-" * 77, "same words here", "same words here", "word " * 3000,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", "y", "z", "d", "c") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], (None, "null id", "x", "y", "z", "d", "c"), (None, None, "x", "y", "z", "d", "c")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_merge_rounds_are_the_library_s(library):
    rng = random.Random(1)
    texts = [t for t in ODD_TEXTS]
    texts += ["".join(rng.choice("abcdehint os  ▁\n.=é漢") for _ in range(rng.randint(1, 120))) for _ in range(500)]
    texts += ["".join(rng.choice(["the", "ing", "th", "an", "nt", "to", " ", "  ", "be", "io", "ng"]) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    e = pieces.PieceEncoder(PIECES, most=300)
    for i in range(0, len(texts), 200):
        part = texts[i : i + 200]
        flat, at = e.encode(pa.array(part, pa.string()))
        want = library.encode([t or "" for t in part])
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == want
        assert [e.vocabulary.decode(flat[a:b]) for a, b in zip(at, at[1:], strict=False)] == [library.decode(w) for w in want]


def test_any_ids_decode_as_in_the_library(spark, library):
    rng = random.Random(2)
    ids = [[rng.choice([0, 1, 2, 28705, 243, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 8))] for _ in range(1000)]
    rows = spark.createDataFrame([*enumerate(ids), (1000, None)], "doc_id long, ids array<long>").repartition(3)
    got = dict(pieces.decode(rows, PIECES).collect())
    assert got == {**{i: library.decode(x) for i, x in enumerate(ids)}, 1000: ""}
    with pytest.raises(Exception, match="not in the model"):
        pieces.decode(spark.createDataFrame([(1, [32000])], "doc_id long, ids array<long>"), PIECES).collect()


def test_pieces_of_tables(docs, odd, empty, library):
    for df in (docs, odd, empty):
        want = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows_of(df))
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in pieces.encode(df, PIECES, decoded=True).collect()) == want


def test_op11(spark, docs, library):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, ids in ((i, library.encode(t or "")) for i, t in rows_of(docs)))
    assert Counter(tuple(r) for r in queries.op11_pieces(spark, SMALL).collect()) == want


def plain_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain_variants(n):
    gaps, near = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            gaps[w[:k], w[k + 1 :]].add(w)
            if (less := w[:k] + w[k + 1 :]) in n:
                near[w].add(less)
                near[less].add(w)
    for words in gaps.values():
        for w in words:
            near[w] |= words - {w}
    form = {w: b for w in n if near[w] and n[b := min(near[w], key=lambda x: (-n[x], x))] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.mark.parametrize("block", [512, 7])
def test_spelling_variants(docs, odd, empty, block):
    for df in (docs, odd, empty):
        got = variants.spelling_variants(variants.count_words(variants.words_of(df)), block=block).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_variants(plain_words(rows_of(df)))


def test_near_words_of_made_tables(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé\U0001f600") for _ in range(rng.randint(5, 9))) for _ in range(1500)} | {"a" * k for k in range(5, 40)} | {"x" * 3000, "x" * 3001, "y" + "x" * 3000}
    n = {w: 3 + rng.randrange(200) for w in words}
    table = spark.createDataFrame([(w, c, "k") for w, c in n.items()], "word string, n long, key string")
    for block, cut in ((512, 4), (50, 2), (50, 5)):
        got = variants.spelling_variants(table.select("word", "n"), pieces=cut, block=block).collect()
        assert {tuple(r) for r in got} == plain_variants(n) and len(got) == len(n)


def test_op12(spark, docs):
    got = queries.op12_variants(spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_variants(plain_words(rows_of(docs)))


def plain_alignment(rows, library):
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    signs = {c: b for b, c in enumerate(align._byte_signs())}
    per = []
    for i, text in rows:
        text = text or ""
        a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else [], library.encode(text)
        raw_a = [bytes(signs[c] for c in tokenizer.id_to_token(x)) for x in a]
        raw_b = [bytes([int(library.id_to_piece(x)[3:5], 16)]) if library.is_byte(x) else library.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or {b"".join(raw_a), b"".join(raw_b)} != {(" " + text).encode()}:
            per.append((i, [], [], [], [], ""))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, links, x, y = [], [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            p, q = x, y
            while x < len(a) and ends_a[x] <= cut:
                x += 1
            while y < len(b) and ends_b[y] <= cut:
                y += 1
            groups.append(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])))
            links += [(a[s], b[t]) for s in range(p, x) for t in range(q, y) if max(ends_a[s] - len(raw_a[s]), ends_b[t] - len(raw_b[t])) < min(ends_a[s], ends_b[t])]
        per.append((i, a, b, groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts, most = Counter(), Counter()
    for row in per:
        counts.update(set(row[4]))
    for (a, _), c in counts.items():
        most[a] = max(most[a], c)
    return Counter((i, len(a), len(b), len(g), len(k), sum(counts[p] == most[p[0]] for p in k), sum(counts[p] for p in k), sha) for i, a, b, g, k, sha in per)


@pytest.mark.parametrize("frequent", [100_000, 50])
def test_alignment(docs, odd, empty, library, frequent, monkeypatch):
    monkeypatch.setattr(align, "FREQUENT", frequent)
    for df in (docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")), odd, empty):
        assert Counter(tuple(r) for r in align.alignment(df, BYTES, PIECES).collect()) == plain_alignment(rows_of(df), library)


def test_op13(spark, docs, library):
    got = queries.op13_alignment(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_alignment(rows_of(docs), library)
    assert got.where(F.col("n_best") > F.col("n_links")).isEmpty()
