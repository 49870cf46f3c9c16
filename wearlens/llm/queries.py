"""The registered query of each operator: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from wearlens.llm import ball_kmeans, bpe, chat, decontam, licenses, lm, near_dedup, outliers, periodic, repeated_spans, secret_scan, suffix_dedup, toxicity
from wearlens.llm.store import id_blocks, keep, with_flags


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _digest(array) :
    return F.sha2(F.array_join(array, ","), 256)


def op4_toxicity_grades(spark, d):
    docs = _table(spark, d, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, d, "labels")))


def op5_decontamination(spark, d):
    found = decontam.find_contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), _digest(F.col("items")).alias("items_sha256"), "contaminated"
    )


def op6_near_dedup(spark, d):
    return near_dedup.near_duplicates(_table(spark, d, "documents"))


def tokens():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def with_digests(encoded, *more):
    """Digests of ids and decoded bytes, computed where the rows are."""
    ids = F.array_join("ids", " ")
    return encoded.select("doc_id", *more, F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark, d):
    return with_digests(bpe.encode(_table(spark, d, "documents").select("doc_id", "text"), tokens(), decoded=True))


def _spans(array):
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")


def op1_preference_pairs(spark, d):
    made = chat.format_preferences(chat.swapped_replies(_table(spark, d, "conversations")))
    return made.withColumns({c: _spans(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


def op3_cross_entropy_difference(spark, d):
    """Target: documents labelled of high quality; background: all."""
    good = _table(spark, d, "labels").filter("quality = 1").select("doc_id", F.lit(True).alias("target"))
    return lm.score(with_flags(_table(spark, d, "documents").select("doc_id", "text"), id_blocks(good, "target"), "target"), "target")


def op7_license_scan(spark, d):
    found = licenses.scan_licenses(_table(spark, d, "documents"), licenses.known_licenses(spark))
    return found.withColumns({c: F.array_join(c, ",") for c in ("whole_licenses", "licenses")})


def op9_repeated_spans(spark, d):
    return repeated_spans.drop_repeated_spans(_table(spark, d, "documents").select("doc_id", "text"))


def op2_secret_scan(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    marks = {k: F.coalesce(F.size(secret_scan.MARK + k), F.lit(0)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")}
    return found.select(
        "doc_id",
        *marks.values(),
        F.sha2(secret_scan.listing(secret_scan.ordered(secret_scan.BASE)), 256).alias("base_sha256"),
        secret_scan.listing(secret_scan.ordered((*secret_scan.BASE, *secret_scan.ADDED))).alias("spans"),
    )


def op10_robust_outliers(spark, d):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return outliers.judge(_table(spark, d, "documents")).select(*names)


def with_periodic_tails(docs):
    """The contract's documents: with crc32 h of the decimal doc_id, one in ten has its words from a on repeated with period p."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    hit = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    hit = hit.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.greatest("n", F.lit(1))))
    hit = hit.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return hit.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, d):
    found = periodic.collapse_runs(with_periodic_tails(_table(spark, d, "documents")))
    # the greatest (length, -start, -period) is the longest run, of those the first, of those the one of least period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    row = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return row.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_suffix_dedup(spark, d):
    found = suffix_dedup.drop_repeats(_table(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_vector_codes(spark, d):
    rows, books = ball_kmeans.encode(_table(spark, d, "embeddings"))
    hexed = F.array_join(F.transform("code", lambda k: F.lpad(F.lower(F.hex(k)), 2, "0")), "")
    rows = keep(rows.select("vec_id", "label", F.when(F.col("code").isNotNull(), hexed).alias("code"), "error"), "coded")
    sums = rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    found = rows.join(sums, F.col("label").eqNullSafe(F.col("same")), "left")
    return found.select("vec_id", "code", "error", "label_error", F.lit(ball_kmeans.digest(books)).alias("codebooks_sha256"))


def all_queries() -> dict:
    return {
        "op1_preference_pairs": op1_preference_pairs,
        "op2_secret_scan": op2_secret_scan,
        "op3_cross_entropy_difference": op3_cross_entropy_difference,
        "op4_toxicity_grades": op4_toxicity_grades,
        "op5_decontamination": op5_decontamination,
        "op6_near_dedup": op6_near_dedup,
        "op7_license_scan": op7_license_scan,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_repeated_spans": op9_repeated_spans,
        "op10_robust_outliers": op10_robust_outliers,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_vector_codes": op13_vector_codes,
    }
