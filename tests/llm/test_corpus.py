"""The corpus operators against plain versions, on the smallest tables and on odd rows."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landweave.llm import common, encoding, exact, html, langid, lines, mixing, packing, pii, queries, simhash, tokens, topk

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, fp string, rank string, salt string"
WS = "[^\x20\x09-\x0d]+"

ODD_TEXTS = [
    None, "", " ", "\n", "...", "a", "One two three.", "One two three.", "one  two\tthree four five six", "x " * 5000, "é ü ß ñ 漢字 \U0001f600 end",
    "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q", "mail me: bob.smith@mail.example.com, card 4539 1488 0343 6467 or +1 (212) 555-0100",
    "ip 10.0.0.256 and 10.0.0.25 iban GB82WEST12345698765432", "line one is here\nline two is here\n\nline three is here", "<|endoftext|> as text ^ | ~",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t), "x", "y", "z", "w") for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[6])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SMALL, "documents")


def plain_ids(name, texts):
    t = Tokenizer.from_file(queries.tokenizer(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_units_encode_as_whole_texts(name, docs):
    texts = [r.text for r in docs.limit(60).collect()] + ODD_TEXTS + ["a\n\nb", " lead", "trail ", "a b", "tab\tbed", " x", "don't 's"]
    e = encoding.Encoder(queries.tokenizer(name), most=500)
    for _ in range(3):
        flat, bounds = e.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == plain_ids(name, texts)


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n in (1, 7, 511, 512, 513, 5000):
        ids = rng.integers(0, 2 ** rng.integers(1, 31, n), n).astype(np.uint32)
        codes = tokens.Codes(tokens.pack_ids(ids))
        assert (codes.all() == ids).all() and len(codes) == n
        assert all(codes[int(i)] == ids[i] for i in rng.integers(0, n, 50))
        with pytest.raises(IndexError):
            codes[n]


def check_tokens(df, out, spark):
    rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, want = 0, []
    for (doc_id, _), ids in zip(rows, plain_ids("word_bpe_49k.json", [t for _, t in rows]), strict=True):
        ids = [*ids, 1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(tuple(r) for r in out.collect()) == Counter(want)


def test_token_file(spark, docs, odd, empty):
    nulls = spark.createDataFrame([(None, "b c"), (3, "a"), (None, "a"), (None, None)], "doc_id long, text string").repartition(3)
    for df in (docs, odd, empty, nulls):
        check_tokens(df, tokens.token_file(df, queries.tokenizer("word_bpe_49k.json")), spark)
    path = common.scratch_path(spark, "t")
    tokens.write_token_file(docs, path, queries.tokenizer("word_bpe_49k.json"), block_tokens=2000)
    r = docs.where("doc_id = 17").first()
    ids = [*plain_ids("word_bpe_49k.json", [r.text])[0], 1]
    assert tokens.tokens_at(spark, path, 17, [0, len(ids) - 1, len(ids)]) == [ids[0], 1]
    with pytest.raises(KeyError):
        tokens.tokens_at(spark, path, -5, [0])


def check_packing(df, out):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    ids = Counter()
    for (doc_id, _), own in zip(rows, plain_ids("byte_bpe_50k.json", [t for _, t in rows]), strict=True):
        own = np.array([*own, 0], "<u4")
        for a in range(0, len(own), 1024):
            part = own[a : a + 1024]
            ids[doc_id, a, len(part), zlib.crc32(part.tobytes()), len(own)] += 1
    got = out.collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == ids
    packs = defaultdict(list)
    for r in got:
        packs[r.sequence_id].append((r.offset, r.length))
    assert sorted(packs) == list(range(len(packs)))
    for own in packs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(packs), sum(r.length for r in got)


def test_packing(docs, odd, empty):
    sequences, used = check_packing(docs, queries.packing.pack(docs, queries.tokenizer("byte_bpe_50k.json")))
    assert sequences <= 1.05 * used / 1024 + 1
    for df in (odd, empty):
        check_packing(df, packing.pack(df, queries.tokenizer("byte_bpe_50k.json")))


def test_histogram_packs_all():
    rng = np.random.default_rng(0)
    for _ in range(20):
        counts = Counter(rng.integers(1, 65, rng.integers(1, 300)).tolist())
        got = Counter()
        for pattern, n in packing.pack_histogram(counts, 64):
            assert sum(pattern) <= 64
            for x in pattern:
                got[x] += n
        assert got == counts
        rows = packing.plan_rows(packing.pack_histogram(counts, 64))
        assert Counter({x: sum(b - a + 1 for y, a, b, *_ in rows if y == x) for x in counts}) == counts


def plain_print(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WS, words)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, distance=4):
    fps = sorted(set(prints.values()))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints.items():
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(f)] for d, f in prints.items()}


def test_simhash(docs, odd, empty):
    for df in (docs, odd):
        rows = {r.doc_id: r.text for r in df.collect()}
        prints = {d: plain_print(t) for d, t in rows.items()}
        comps = plain_components(prints)
        got = simhash.near_duplicates(df).collect()
        assert len(got) == df.count()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{prints[d]:016x}", comps[d]) for d in rows}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    # texts without words are one group, as are the two equal ones and the two that share 11 of 13 shingles
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4, 5, 6, 8, 9, 10, 11, *range(13, len(ODD_TEXTS))]
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(4000)])
    rows, near = [], set()
    for i in range(0, 400, 2):
        own = words[rng.integers(0, 4000, 400)]
        copy = own.copy()
        changed = [2, 5, 60][i // 2 % 3]
        copy[rng.choice(400, changed, replace=False)] = "new"
        sets = [{tuple(x[k : k + 5]) for k in range(396)} for x in (own, copy)]
        if len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8:
            near.add(i + 1)
        rows += [(i, " ".join(own)), (i + 1, " ".join(copy))]
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = {d for d, _ in rows} - kept
    assert gone <= near and len(gone) >= 0.9 * len(near)


def plain_shingles(text, width=5):
    words = re.findall(WS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def plain_groups(texts, least=0.8, apart=None, distance=28):
    """The groups of near duplicates by comparing all pairs: the smallest position of each text's group. `apart` collects the pairs."""
    sets, root = [plain_shingles(t) for t in texts], list(range(len(texts)))
    prints = [simhash.wide_fingerprint(np.unique(np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in s], np.uint64))) for s in sets]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                bits = int(np.bitwise_count(prints[i] ^ prints[j]).sum())
                if apart is not None:
                    apart.append((j, i, bits))
                if bits <= distance:
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return [find(i) for i in range(len(texts))]


def test_copies_within_a_template_go(spark):
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(4000)])
    common_part, texts = words[rng.integers(0, 4000, 300)], [" ".join(words[rng.integers(0, 4000, 300)])]
    for _ in range(60):
        own = words[rng.integers(0, 4000, 110)]
        copy = own.copy()
        copy[50] = "new"
        texts += [" ".join([*common_part, *x]) for x in (own, copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for more in ({}, {"volume": 4000}, {"distance": 60}):
        want = plain_groups(texts, distance=more.get("distance", 28))
        assert len(set(want)) < 0.6 * len(texts)
        assert sorted(r.doc_id for r in simhash.drop_near_duplicates(df, **more).collect()) == sorted(set(want))


def test_recall_of_links_within_one_family(spark):
    """Over 500 texts of one family: pairs at a similarity of 0.8 or more that the operator puts in one group, of all such pairs."""
    rng = np.random.default_rng(23)
    words = np.array([f"w{i}" for i in range(4000)])
    base, texts = words[rng.integers(0, 4000, 250)], []
    for _ in range(260):
        own = base.copy()
        own[rng.choice(250, 14, replace=False)] = words[rng.integers(0, 4000, 14)]  # to the base about 0.6
        copy = own.copy()
        copy[rng.choice(250, int(rng.integers(1, 6)), replace=False)] = "new"  # 0.8 to 0.98
        texts += [" ".join(own), " ".join(copy)]
    pairs: list = []
    want = plain_groups(texts, apart=pairs, distance=128)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.drop_near_duplicates(df).collect()}
    assert kept >= set(want)  # no text goes that is not in a group with a smaller one
    lost = len(kept) - len(set(want))
    assert len(pairs) >= 200 and lost <= 0.1 * (len(texts) - len(set(want)))


def test_equal_fingerprints_of_unlike_texts_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(100)) + " -" * 130 for c in "ab"]
    assert simhash.fingerprint(texts[0], 5) == simhash.fingerprint(texts[1], 5)  # of repeated shingles; sets have others
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[1]), (4, texts[1].replace("b50", "new"))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_null_and_shared_doc_ids_keep_unlike_texts(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    rows = [(None, text["a"]), (None, text["a"]), (None, text["b"]), (5, text["b"]), (7, text["c"]), (7, text["d"]), (7, text["d"])]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter([(None, text["a"]), (5, text["b"]), (7, text["c"]), (7, text["d"])])


def test_links_of_hot_keys_connect(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    fps = {base}
    while len(fps) < 300:
        f = int(rng.choice(list(fps)))
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            f ^= 1 << int(b)
        fps.add(f)
    fps = sorted(fps)
    prints = dict(enumerate(fps))
    rows = [(int(np.uint64(f).astype(np.int64)), 0) for f in fps]
    nodes = common.written(spark.createDataFrame(rows, "fp long, fp2 long"), "n")
    want = plain_components(prints)
    number = {f"{f:016x}": i for i, f in prints.items()}
    for tile in (20, 100_000):
        for count in (300, 1 << 36):  # wider keys find the same
            links = simhash.near_links(nodes.select("fp"), 4, simhash.certain_keys(count, 4, F.col("fp")), tile=tile)
            for r in links.collect():
                assert (prints[number[r.a.hex()]] ^ prints[number[r.b.hex()]]).bit_count() <= 4 and r.a > r.b
            roots = {number[r.node.hex()]: number[r.root.hex()] for r in simhash.connected(links).collect()}
            assert {i: roots.get(i, i) for i in prints} == want


def check_exact(df, keep, **more):
    groups = defaultdict(list)
    rows = df.collect()
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    best = max if keep == "largest" else min
    kept = {t: best([x for x in own if x is not None], default=None) for t, own in groups.items()}
    want = Counter((r.doc_id, kept[r.text or ""], len(groups[r.text or ""]), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    got = exact.exact_duplicates(df, keep=keep, **more).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact(docs, odd, empty):
    check_exact(docs, "largest")
    check_exact(odd, "smallest")
    check_exact(odd, "largest", digest_chars=1)  # colliding keys
    check_exact(empty, "largest")
    nulls = [(None, "a"), (None, "a"), (3, "b"), (None, "b"), (None, None), (7, ""), (7, "c"), (8, "c"), (8, "d")]
    for keep in ("smallest", "largest"):
        check_exact(docs.sparkSession.createDataFrame(nulls, "doc_id long, text string"), keep)


def test_filter_of_digests(spark):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(4000)]
    df = spark.createDataFrame([(d,) for d in digests], "digest string")
    for count in (100, 200_000):  # one segment, several
        held = exact.build_filter(df.limit(1000), count)
        got = {r.digest for r in df.where(exact.may_hold(F.col("digest"), held)).collect()}
        assert {r.digest for r in df.limit(1000).collect()} <= got and len(got) < 1100


def test_digest_index(spark):
    index = exact.DigestIndex(spark, fan_in=3)
    for batch in ([(5, "a"), (3, "a"), (9, "b")], [(1, "b"), (4, "c")], [(2, "c")]):
        index.flush(spark.createDataFrame(batch, "doc_id long, digest string"))
    assert len(index.runs) == 1 and len(index.levels) == 2
    assert sorted(map(tuple, index.lookup(["a", "b", "x"]).collect())) == [("a", 3, 2), ("b", 1, 2)]
    with pytest.raises(ValueError):
        exact.DigestIndex(spark, keep="first")


def test_lines(spark, docs, odd, empty):
    shared, near = "this line is everywhere", "this line is on two"
    rows = [(i, f"own {i} text here\n{shared}\n{near if i < 2 else 'x'}\n {shared} ", f"s{i}", 0) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = {r.doc_id: r for r in lines.remove_boilerplate(df, min_sites=3).collect()}
    assert got[0].text == f"own 0 text here\n{shared}\n{near}"
    assert got[5].text == "own 5 text here\nx" and got[5].n_chars == len(got[5].text)
    assert tuple(got[5].line_report) == (4, 2)
    out = lines.remove_boilerplate(odd, min_sites=2)
    assert out.columns == [*odd.columns, "line_report"] and out.count() == odd.count()
    assert lines.remove_boilerplate(empty).count() == 0


def check_mix(df, whole):
    rows = df.collect()
    got = mixing.mix_plan(df, whole_documents=whole).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(re.findall(WS, r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        left = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / left for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    source = {r.doc_id: r.source for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.mix.source_size == sizes[s] and abs(r.mix.target - target[s]) < 1e-6 * max(1, total)
        assert 0 <= r.mix.taken <= 3 * r.mix.size and r.mix.taken == sum(p.words for p in r.mix.passes)
        positions = [p.position for p in r.mix.passes]
        assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
        taken[s] += r.mix.taken
    most = max([len(re.findall(WS, r.text or "")) for r in rows], default=0)
    for s in order:
        assert abs(taken[s] - target[s]) <= (most if whole else 1)


def test_mix(spark, docs, odd, empty):
    for df in (docs, odd.dropDuplicates(["doc_id"]), empty):
        check_mix(df, False)
        check_mix(df, True)
    out = mixing.mix(odd)
    assert out.columns == [*odd.columns, "mix"] and out.count() == odd.count()
    rows = [(1, "a b", "s"), (1, "a b c", "s"), (1, "a b", "s"), (None, "d", None), (None, "e f", "s"), (2, None, "t")]
    shared = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, source string, plan_id int, size int")
    got = mixing.mix(shared, whole_documents=True).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    assert all(r.mix.size == len((r.text or "").split()) for r in got)
    assert got == mixing.mix(shared.repartition(3), whole_documents=True).collect() or Counter(map(str, got)) == Counter(map(str, mixing.mix(shared.repartition(3), whole_documents=True).collect()))
    ordered = mixing.in_training_order(mixing.mix(docs)).select("mix.position").toPandas()["position"]
    assert ordered.is_monotonic_increasing and (ordered.value_counts() < 50).all()


def plain_base(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0

    out, t = [], text or ""
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, p in kinds.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark, docs, odd, empty):
    hard = ["a@b.c_d@e.f g@h", "1.2.3.4.5.6.7.8 0001.02.3.255 256.1.1.1 1.1.1.1", "4539-1488 0343-6467 4539148803436467 12 4539 1488 0343 6467 1", "+1 2-3.(4)5678 9 +12+34567890", "9" * 30000, "a." * 20000, "x" * 50000 + "@b.cd", "é@b.c 😀 me@x.yz"]
    more = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    for df in (docs.select("doc_id", "text"), odd, more, empty):
        for r in pii.find_pii(df).collect():
            base = [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in pii.BASE]
            assert base == plain_base(r.text)
            assert all(r.text[s.start : s.end] == s.body for s in r.pii)
    # Many spans: chunks meet without a seam, and context reaches over it.
    many = "".join(f"x{i}@y.zz " + ("call " if i % 7 == 0 else "") + f"+1234567{i % 10}0 " for i in range(700))
    (row,) = pii.find_pii(spark.createDataFrame([(1, many)], "doc_id long, text string")).collect()
    assert [f"{s.kind}:{s.start}:{s.end}" for s in row.pii] == plain_base(many)
    for s in row.pii:
        before = many[max(0, s.start - 40) : s.start].lower()
        near = re.search(rf"(?:^|[^a-z])(?:{'|'.join(pii.CONTEXT_WORDS[s.kind])})(?:[^a-z]|$)", before)
        assert s.score == (1.0 if near else 0.7)
    began = time.time()
    long = spark.createDataFrame([(1, "me@x.yz " * 20_000)], "doc_id long, text string")
    assert pii.find_pii(long).select(F.size("pii").alias("n")).first().n == 20_000 and time.time() - began < 15
    got = {r.doc_id: r.pii for r in pii.find_pii(odd).collect()}
    assert [(s.kind, s.score) for s in got[14]] == [("ip", 1.0), ("iban", 1.0)]
    assert [(s.kind, s.score) for s in got[13]] == [("email", 1.0), ("card", 1.0), ("phone", 0.7)]
    assert "<card>" in {r.doc_id: r.text for r in pii.masked(odd).collect()}[13]


def test_language(spark, docs, odd, empty):
    profiles = langid.fit_profiles(docs.where(~langid.is_held_out()))
    got = langid.identify(docs, profiles).where(langid.is_held_out()).collect()
    assert sum(r.lang == r.language.lang_pred for r in got) >= 0.95 * len(got)
    for r in langid.identify(odd, profiles).collect():
        assert (r.language.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.language.score <= 1
    assert langid.identify(empty, profiles).count() == 0 and langid.fit_profiles(empty) == {}
    unnamed = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert unnamed.where(~langid.is_held_out()).count() == 0 and unnamed.where(langid.is_held_out()).count() == docs.count()
    # Prediction and score of every document by a plain version, and letters beyond a-z.
    plain = {lang: plain_profile(lang, docs) for lang in profiles}
    for lang, codes in profiles.items():
        assert codes == [gram_code(g) for g in plain[lang]]
    more = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(["Ünïcöde häß Ωμέγα", "привет мир", "漢字 かな", "a" * 50_000, "aa bb aa bb", ODD_TEXTS[2]])], "doc_id long, text string, lang string, source string")
    for df in (docs, more):
        for r in langid.identify(df, profiles).collect():
            assert tuple(r.language) == plain_language(r.text, plain)
    cyrillic = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("καλημέρα κόσμε τι κάνεις", "el"), ("hello there world", "en")])], "doc_id long, text string, lang string")
    own = langid.fit_profiles(cyrillic)
    asked = spark.createDataFrame([("дела мир",), ("κόσμε",), ("the world",)], "text string")
    assert {r.text: r.language.lang_pred for r in langid.identify(asked, own).collect()} == {"дела мир": "ru", "κόσμε": "el", "the world": "en"}
    tied = {"b": own["en"], "c": own["en"]}
    assert langid.identify(asked, tied).first().language.lang_pred == "b"


def plain_grams(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" "):
        if word:
            out.update(word)
            padded = f" {word} "
            out.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
    return out


def gram_code(g):
    p = [0 if c == " " else ord(c) for c in g]
    return -p[0] if len(p) == 1 else (p[0] << 42) | p[1] if len(p) == 2 else (p[0] << 42) | (p[1] << 21) | p[2]


def plain_profile(lang, docs):
    total = Counter()
    for r in docs.where(~langid.is_held_out()).where(F.col("lang") == lang).collect():
        total.update(plain_grams(r.text))
    return sorted(total, key=lambda g: (-total[g], gram_code(g)))[:300]


def plain_language(text, profiles):
    counts = plain_grams(text)
    ranked = sorted(counts, key=lambda g: (-counts[g], gram_code(g)))[:300]
    if not ranked:
        return ("und", 0.0)
    far = {lang: sum(abs(own.index(g) - i) if g in own else 300 for i, g in enumerate(ranked)) / (len(ranked) * 300) for lang, own in profiles.items()}
    best = min(sorted(far), key=far.__getitem__)
    return (best, 1.0 - far[best])


def test_html(spark):
    pages = common.table(spark, "/root/testdata/sf0.01", "pages")
    model = html.fit_labeller(pages)
    wrong = 0
    for r in html.extract(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = " ".join(re.sub(r"<[^>]*>", lambda m: " " if re.match(r"</?(p|br|h1|li|ul|div|blockquote)\b", m[0]) else "", body).split())
        import html as entities

        want = " ".join(" ".join(entities.unescape(x).split()) for x in [want])
        wrong += r.text != want
        assert r.n_chars == len(r.text)
    assert wrong <= 2
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain"), (4, "u", "<p"), (4, "u", "<p"), (5, "u", "<div>" * 3000 + "x")]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert len(out) == 6 and {r.page_id: r.text for r in out}[1] == ""
    found = html.blocks("<nav><a href=x>A &amp; B</a></nav><article><p>Some <b>bo</b>ld<br>text&nbsp; here<p>next<script>var x='<p>'</script></article>")
    assert [b.text for b in found] == ["A & B", "Some bold text here", "next"]
    texts = lambda page: [b.text for b in html.blocks(page)]
    assert texts("<article><p>one</p><button>x<p>two</p><select><option>y<p>three</p></article>") == ["one", "two", "three"]
    assert texts("<p>a</p><button>x</button><p>b</p><button>y<p>c</p><button>z</button><p>d</p>") == ["a", "b", "c", "d"]
    assert texts("<p>a</p><script>var x = '<p>';") == ["a"] and texts("a < b <c and d") == ["a < b <c and d"]
    assert texts('<p title="a > b">x</p><p class="y>z</p>') == ["x", "z"]
    # very long pages of any markup take time in proportion
    for unit in ("<a ", "<div>x", '<a "', "<!--", "<!x ", "<button>", "<p>x<li>", "<b><i>x</b>", "</svg", "<svg>", "<td><div>", "<script>", "<a class='"):
        began = time.time()
        html.blocks(unit * (1_000_000 // len(unit)))
        html.blocks(unit * (500_000 // len(unit)) + ">")
        assert time.time() - began < 20, unit
    clashing = spark.createDataFrame([(1, "u", "<p>x", "t", 5), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    assert html.extract(clashing, model).columns == ["page_id", "url", "text", "n_chars"]
    assert html.extract(clashing.limit(0)).count() == 0


#: Markup that no training page has: article and other parts of a page.
OTHER_TEMPLATES = [
    ('<div class="single-column"><div class="prose">{0}</div></div>', '<div class="topbar menu"><a href="/">Home</a> <a href="/a">About us</a></div>', '<div class="page-footer footer"><p>Copyright, all rights reserved</p></div>'),
    ('<main id="page"><section>{0}</section></main>', '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>', '<aside><p>Read also this</p></aside><footer>Contact and imprint</footer>'),
    ('<div id="wrap"><div class="post-body">{0}</div></div>', '<header><p>The daily page</p></header>', '<div class="comments"><p>Nice one, thank you for it!</p><p>I do not agree at all.</p></div>'),
]


@pytest.mark.parametrize("tagged", [True, False])
def test_html_of_other_templates(spark, tagged):
    """Block by block, on markup that was not trained on; also where no page has an article element to learn from."""
    pages = common.table(spark, "/root/testdata/sf0.01", "pages")
    if not tagged:
        pages = pages.withColumn("html", F.regexp_replace("html", "(</?)(article|main)", "$1div"))
    model = html.fit_labeller(pages)
    docs = [r.text for r in common.table(spark, SMALL, "documents").where("n_chars between 300 and 3000").limit(60).collect()]
    right = total = 0
    for i, text in enumerate(docs):
        body, before, after = OTHER_TEMPLATES[i % len(OTHER_TEMPLATES)]
        words = text.split()
        article = [" ".join(words[k : k + 40]) for k in range(0, len(words), 40)]
        page = f"<html><body>{before}{body.format(''.join(f'<p>{x}</p>' for x in article))}{after}</body></html>"
        found = html.blocks(page)
        p = dict(html.labelled(model, [found]))[0]
        for b, y in zip(found, p, strict=True):
            right += (y > 0.5) == (b.text in {" ".join(x.split()) for x in article})
            total += 1
    assert right >= (0.95 if tagged else 0.9) * total


LONG = "Words of this sentence are made for a long paragraph of the article, which goes on and on until it is long enough to be one of many."
#: Held-out pages: what belongs to the article is between brackets.
HELD_OUT = [
    "<nav><ul><li><a>Home</a></li></ul></nav><article><h1>[The title here]</h1><p>[{0}]</p><p><a href=x>[A paragraph of the article that is a link as a whole]</a></p><p>[{0}]</p></article><footer>Imprint</footer>",
    "<article><h1>[The title here]</h1><p>[{0}]</p><p>[{0}]</p><section class='discussion'><h3>3 replies</h3><p>nice one, thank you</p><p>I do not agree with that at all</p></section></article>",
    "<div class='xq'><div class='zap'><h1>[The title here]</h1><p>[{0}]</p><p>[{0}]</p><p>[{0}]</p></div><div class='krs'>All rights reserved 2020</div></div>",
    "<div class='menu'><a>Home</a> <a>News</a></div><div class='xq'><h1>[The title here]</h1><p>[{0}]</p><ul><li>[One thing of the list]</li><li><a>[Another thing]</a></li></ul><p>[{0}]</p></div><div class='related'><ul><li><a>Other page</a></li></ul></div>",
    "<header><p>The paper of the day</p></header><div class='body'><p>[{0}]</p><table><tr><td>[One cell of it]</td><td>[Another cell]</td></tr></table><pre>[some code here]</pre><p>[{0}]</p><ol class='thread'><li>12 comments</li><li>first</li><li>Thanks for this</li></ol></div>",
]


def test_html_of_held_out_pages(spark):
    """Links, lists and tables of an article, comments under other classes, pages whose classes say nothing."""
    model = html.fit_labeller(common.table(spark, "/root/testdata/sf0.01", "pages"))
    wrong, total = [], 0
    for page in HELD_OUT:
        found = html.blocks(f"<html><body>{page.format(LONG)}</body></html>")
        total += len(found)
        wrong.append(sum((y > 0.5) != (b.text.startswith("[") and b.text.endswith("]")) for b, y in zip(found, dict(html.labelled(model, [found]))[0], strict=True)))
    assert wrong[:2] == [0, 0] and sum(wrong) <= 0.15 * total


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    m = html.Labeller(1)
    x = rng.standard_normal((2, 4, html.WIDTH)).astype(np.float32)
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], np.float32)
    y = rng.integers(0, 2, (2, 4)).astype(np.float32)

    def loss():
        p = np.clip(m.forward(x, mask), 1e-6, 1 - 1e-6)
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum())

    grads = m.gradients(x, mask, y)
    for name in ("xf", "hb", "cf", "o", "p"):
        flat = m.w[name].reshape(-1)
        i = int(np.abs(grads[name].reshape(-1)).argmax())
        old, eps = flat[i], 1e-2
        flat[i] = old + eps
        up = loss()
        flat[i] = old - eps
        down = loss()
        flat[i] = old
        assert abs((up - down) / (2 * eps) - grads[name].reshape(-1)[i]) < 2e-2


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(-9, 10, (700, 6))
    x[100:400] = x[100]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0] * 6)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("id") % 20 == 0, k=20, pivots=5, seeds=1).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    vecs = dict(rows[:700]) | {901: [0] * 6}
    for q in [i for i in vecs if i % 20 == 0]:
        scores = sorted(((-int(np.dot(vecs[q], v)), i) for i, v in vecs.items() if i != q))[:20]
        assert got[q] == [(i, -s) for s, i in scores]
    # many annuli to a pivot, and far clusters: blocks are left out, and nothing is lost by it
    spread = np.concatenate([rng.integers(-9, 10, (60, 6)) + 400 * rng.integers(-1, 2, 6) for _ in range(12)])
    far = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(spread)], "id long, v array<long>")
    asked, of = [], topk._search
    monkeypatch.setattr(topk, "_search", lambda queries, pairs, index, *more: (asked.append((pairs.count(), index.count())), of(queries, pairs, index, *more))[1])
    got = defaultdict(list)
    for r in topk.top_k(far, F.col("id") % 20 == 0, k=5, pivots=12, seeds=2, block=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 720, 20):
        assert got[q] == [(i, -s) for s, i in sorted((-int(np.dot(spread[q], v)), i) for i, v in enumerate(spread) if i != q)[:5]]
    assert asked[0][1] > 60 and sum(n for n, _ in asked) < 0.7 * 36 * asked[0][1]
    monkeypatch.undo()
    few = spark.createDataFrame(rows[:3], "id long, v array<long>")
    odd = [(20, [1, 2]), (40, []), (1, [3]), (2, [1 << 40, -(1 << 40), 5]), (None, [9, 9]), (20, [7, 7]), (60, [1 << 62, 1 << 62]), (3, None)]
    found = topk.top_k(spark.createDataFrame(odd, "id long, v array<long>"), F.col("id") % 20 == 0, k=9).collect()
    at = lambda v, i: v[i] if i < len(v) else 0
    dot = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(at(a, i) * at(b, i) for i in range(3))))
    there = [(n, i, v) for n, (i, v) in enumerate(odd) if i is not None and v is not None]
    want = Counter((q, i, dot(v, x)) for n, q, v in there if q % 20 == 0 for m, i, x in there if m != n)
    assert Counter((r.query_id, r.vec_id, r.score) for r in found) == want
    assert topk.top_k(few, F.col("id") == 0).count() == 2
    assert topk.top_k(few.limit(0), F.col("id") == 0).count() == 0
    bad = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, None]), (3, [0.5, -0.01]), (4, None)], "id long, e array<float>")
    assert {r.id: r.v for r in bad.select("id", topk.quantised(F.col("e")).alias("v")).collect()} == {1: None, 2: None, 3: [32, -1], 4: None}
