"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, exact, html, langid, lines, mixing, packing, pieces, pii, simhash, tokens, topk, variants
from .common import table

#: The tokenizers' files; a path is a parameter of the operators.
def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(rows, F.col("id") % 20 == 0, k=20)


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_file(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove_boilerplate(table(spark, sf_dir, "documents"), min_sites=10, site="source", min_words=3)
    return out.select("doc_id", "text", "line_report.n_lines", "line_report.n_removed")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    mark = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(F.array_join(F.transform(base, mark), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii", mark), ",").alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"),
    )


def op5_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    first = F.get("mix.passes", F.lit(0))["position"]
    rows = plan.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", F.round(first, 6).alias("position"))
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4, seed=42)


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.fit_profiles(docs.where(~langid.is_held_out()))
    out = langid.identify(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", langid.is_held_out().alias("held_out"), "language.lang_pred", "language.score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), size=1024, end_id=0)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), decoded=True)
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.words_of(table(spark, sf_dir, "documents"), planted=97)
    return variants.spelling_variants(variants.count_words(words, least_length=5, least_count=3), times=2)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_topk, op2_token_codes, op3_line_spread, op4_pii, op5_curriculum, op6_main_text, op7_simhash, op8_exact, op9_language, op10_packing, op11_pieces, op12_variants, op13_alignment)
}
