"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored and
read again as the next one's documents. All but the last return the columns of ``documents``.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.llm import jaccard, langid, packing, quality, suffixes
from anchorage.sources import sinks


USED = ("doc_id", "text", "lang")


def hidden(docs):
    """The documents with all other columns renamed, so that none clashes with what a stage adds."""
    return docs.select(*[F.col(c).alias(c if c in USED else f"_extra{i}") for i, c in enumerate(docs.columns)])


def restored(found, docs, text="text"):
    """The columns of the documents again, with the given text; ``n_chars`` follows it."""
    back = {c: F.col(c if c in USED else f"_extra{i}") for i, c in enumerate(docs.columns)}
    back["text"] = F.col(text)
    if text != "text" and "n_chars" in back:
        back["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[column.alias(c) for c, column in back.items()])


def quality_rules(spark, docs, sf_dir):
    """Documents that the line rules keep, without the lines that fail.

    Null, empty and very short texts go. Repeated rows stay for later stages. ``n_chars`` is
    counted anew; other columns, null ones too, are passed on.
    """
    return restored(quality.clean(hidden(docs)).where("kept"), docs, "clean_text")


LEAST_SCORE = 0.4


def language_id(spark, docs, sf_dir):
    """Documents in a language: without a letter, or with a score under LEAST_SCORE, they go.

    If no row has a text and a language there is nothing to learn, and all texts with a
    letter stay. The ``lang`` column is left as it is.
    """
    model = langid.fit(langid.learnable(docs))
    found = langid.predict(hidden(docs), model)
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return restored(found.where(sure if model["langs"] else F.col("text").rlike(r"\p{L}")), docs)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies the document with the smallest id.

    Of the rows of that id one stays, the first in order of text and the other columns.
    Rows without id stay, and so does a text without a word.
    """
    groups = jaccard.join(docs).where("doc_id is not null and doc_id = group_id").select("doc_id").distinct()
    rows = hidden(docs).join(groups, "doc_id", "left_semi")
    sortable = [c for c, kind in rows.dtypes if c != "doc_id" and not kind.startswith(("map", "variant"))]
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*sortable))
    one = rows.withColumn("_first", first).where("_first = 1").drop("_first")
    return restored(one.union(hidden(docs).where("doc_id is null")), docs)


def repeated_passages(spark, docs, sf_dir):
    """Texts without the 50-byte strings that a document with a smaller id holds.

    Characters that a cut goes through are dropped; ``n_chars`` is counted anew. A text of
    which nothing is left goes; others stay, however short. A null text comes back empty.
    """
    rows = hidden(docs)
    found = suffixes.dedup(rows, keep=[c for c in rows.columns if c not in ("doc_id", "text")])
    return restored(found.where("length(kept_text) > 0 or n_removed = 0"), docs, "kept_text")


def packed(spark, docs, sf_dir):
    """Token pieces of at most 2048 ids in sequences."""
    import public_tokenizers

    table = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=0)
    return packing.pack(table, length=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed),
]

# SQL has no tokenizer, no logistic regression and no packing; the tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return reduce(lambda d, stage: sinks.materialize(stage[1](spark, d, sf_dir)), STAGES[:-1], docs).transform(
        lambda d: STAGES[-1][1](spark, d, sf_dir)
    )
