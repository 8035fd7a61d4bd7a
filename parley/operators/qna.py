"""Question-answer pairs of a single speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PairConfig
from ..functions.scalar import word_count

def by_file():
    return W.partitionBy("file_id").orderBy("gpos")


def split_sentences(words: DataFrame) -> DataFrame:
    """Adds `sentence`: it ends after a word that ends with . ? or !, whatever the segment; the rest is one too."""
    ended = F.lag("text").over(by_file()).rlike(r"[.?!]$")
    w = words.withColumn("e", F.coalesce(ended, F.lit(False)).cast("int"))
    return w.withColumn("sentence", F.sum("e").over(by_file().rowsBetween(W.unboundedPreceding, W.currentRow))).drop("e")


def is_question(text, cfg: PairConfig):
    first = F.regexp_replace(F.lower(F.split(text, " ")[0]), r"^[.,?!]+|[.,?!]+$", "")
    return text.endswith("?") | first.isin(*cfg.interrogatives)


def sentences(words: DataFrame, cfg: PairConfig) -> DataFrame:
    """`file_id, sentence, text, first_gpos, question`."""
    said = F.expr("trim(array_join(transform(array_sort(collect_list(struct(gpos, text))), x -> x.text), ' '))")
    s = split_sentences(words).groupBy("file_id", "sentence").agg(said.alias("text"), F.min("gpos").alias("first_gpos"))
    return s.withColumn("question", is_question(F.col("text"), cfg))


def build_qna(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """Pair rows: a question and the sentences up to the next; questions without an answer are left out."""
    s = sentences(words, cfg).withColumn("q", F.sum(F.col("question").cast("int")).over(W.partitionBy("file_id").orderBy("sentence").rowsBetween(W.unboundedPreceding, W.currentRow)))
    w = split_sentences(words).join(s.filter("q > 0").select("file_id", "sentence", "q", "question"), ["file_id", "sentence"])
    item = "struct(gpos, text, speaker, start, end, score)"
    g = w.groupBy("file_id", "q").agg(
        F.expr(f"array_sort(collect_list(if(question, {item}, null)))").alias("asked"), F.expr(f"array_sort(collect_list(if(question, null, {item})))").alias("words"), F.expr("avg(if(question, null, score))").alias("avg_score")
    )
    g = g.filter(F.size("words") > 0).withColumn("i", F.row_number().over(W.partitionBy("file_id").orderBy("q")) - 1)
    text = lambda c: F.trim(F.array_join(F.transform(c, lambda x: x["text"]), " "))
    g = g.withColumns({"input": text("asked"), "output": text("words")})
    return g.select(
        "file_id", F.concat(F.lit("qna-"), F.col("i").cast("string")).alias("seg_idx"), F.col("i").cast("long").alias("seg_ord"), "input", word_count("input").alias("input_len"), "output",
        word_count("output").alias("output_len"), F.lit(target).alias("output_speaker"), "avg_score", F.col("words")[0]["start"].alias("tstart"), F.element_at("words", -1)["end"].alias("tend"), "words",
    )
