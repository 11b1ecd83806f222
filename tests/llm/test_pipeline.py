"""The pipeline's stages, each on its own input, against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline as p
from landweave.llm import common, langid
from tests.llm import test_corpus as plain


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def plain_language(rows, docs):
    profiles = {lang: plain.plain_profile(lang, docs) for lang in sorted({r.lang for r in docs.where(~langid.is_held_out()).collect()} - {None})}
    found = [(r, plain.plain_language(r.text, profiles)) for r in rows]
    return Counter((r.doc_id, r.text, r.lang, r.source) for r, (lang, score) in found if lang != "und" and score >= p.LEAST_SCORE)


def plain_lines(rows):
    trim = lambda line: line.strip(" \t\n\x0b\x0c\r")
    sites, first = defaultdict(set), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        for pos, line in enumerate((r.text or "").split("\n")):
            if len(re.findall(plain.WS, line)) >= 3:
                sites[trim(line)].add(r.source or "")
                first.setdefault(trim(line), (r.doc_id, pos))
    out = Counter()
    for r in rows:
        kept = [x for pos, x in enumerate((r.text or "").split("\n")) if len(re.findall(plain.WS, x)) < 3 or len(sites[trim(x)]) < 10 or first[trim(x)] == (r.doc_id, pos)]
        out[r.doc_id, "\n".join(kept), r.lang, r.source] += 1
    return out


def plain_near(rows):
    rows = sorted(rows, key=lambda r: r.doc_id)
    return Counter((rows[i].doc_id, rows[i].text, rows[i].lang, rows[i].source) for i in set(plain.plain_groups([r.text for r in rows])))


def plain_mix(rows):
    size = {r.doc_id: len(re.findall(plain.WS, r.text or "")) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size[r.doc_id]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    capped: set = set()
    while True:
        share = (sum(sizes.values()) - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        over = {s for s in order if s not in capped and weight[s] * share > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    out, place = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)):
        words = int(3 * sizes[r.source] if r.source in capped else weight[r.source] * share)
        full, rest = divmod(words, sizes[r.source]) if sizes[r.source] else (0, 0)
        last = full < 3 and rest - place[r.source] >= size[r.doc_id] / 2
        place[r.source] += size[r.doc_id]
        if size[r.doc_id] and full + last:
            out[r.doc_id, r.text, r.lang, r.source] += full + last
    return out


def test_stages(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    now, want = docs, {"language": lambda rows, df: plain_language(rows, df), "line_dedup": lambda rows, df: plain_lines(rows), "near_dedup": lambda rows, df: plain_near(rows), "mix": lambda rows, df: plain_mix(rows)}
    for name, stage in p.STAGES[:-1]:
        out = common.written(stage(spark, now, ""), name)
        assert out.columns == docs.columns, name
        assert rows_of(out) == want[name](now.collect(), now), name
        now = out
    plain.check_packing(now, p.STAGES[-1][1](spark, now, ""))


def test_odd_rows_and_empty_tables(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t), i, "x") for i, t in enumerate(plain.ODD_TEXTS)]
    rows += [rows[6], (None, "some more words here", "en", None, 20, 1, None), (None, None, None, None, None, None, None), (3, "other text of three", "en", "s", 19, 1, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node int, __root string"
    odd = spark.createDataFrame(rows, schema)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, odd, "").collect()
        assert out and tuple(out[0].__fields__) == tuple(odd.columns), name
        if name == "line_dedup":
            assert len(out) == len(rows)
        assert stage(spark, odd.limit(0), "").count() == 0, name
    plain.check_packing(odd, p.STAGES[-1][1](spark, odd, ""))
    assert p.STAGES[-1][1](spark, odd.limit(0), "").count() == 0
