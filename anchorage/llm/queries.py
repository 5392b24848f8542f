"""The registered queries of the operators."""

from pyspark.sql import functions as F

from anchorage.llm import (
    jaccard,
    langid,
    licenses,
    merkle,
    packing,
    quality,
    sentences,
    sketches,
    suffixes,
    tokens,
    tries,
    urls,
    windows,
)
from anchorage.sources import sinks


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def jaccard_join(spark, sf_dir):
    """Class, links and group of every document: 5-word shingles, similarity 0.8 or more."""
    return jaccard.join(_read(spark, sf_dir, "documents"), n=5, threshold=0.8)


def token_counts(spark, sf_dir):
    """Token counts of whole texts, and the longest prefix of 1024 tokens."""
    limit = 1024
    found = tokens.budgets(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), [limit])
    return found.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("fits")[0].alias("fit_chars"),
    )


def best_fit_packing(spark, sf_dir):
    """Sequences of at most 2048 tokens."""
    table = packing.pieces(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), length=2048, end_id=0)
    return packing.pack(table, length=2048)


def quality_rules(spark, sf_dir):
    """Base counts and the verdict of the line-first rules."""
    return quality.clean(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_removed",
        "lost_chars",
    )


def sentencepiece(spark, sf_dir):
    """Ids of whole texts, and a hash of what decoding gives back."""
    path = _vocabulary("piece_bpe_32k.model")
    return sentences.encode(_read(spark, sf_dir, "documents"), path, decoded="text").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


def url_filters(spark, sf_dir):
    """Verdicts on all page urls; a page's label is that of the document its url numbers."""
    labels = _read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("key"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return urls.judge(_read(spark, sf_dir, "pages"), labels)


def language_id(spark, sf_dir):
    """Languages of all documents, learnt from three quarters of them."""
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(langid.learnable(docs))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


def suffix_dedup(spark, sf_dir):
    """What earlier documents hold too, in strings of 50 bytes."""
    return suffixes.dedup(_read(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256"
    )


def fingerprints(spark, sf_dir):
    """Bottom-k sketches of all documents and of their edited texts."""
    return sketches.edit_likeness(_read(spark, sf_dir, "documents"))


def license_scans(spark, sf_dir):
    """License phrases and templates in all documents."""
    return licenses.scan(_read(spark, sf_dir, "documents")).drop("spans")


def merkle_manifest(spark, sf_dir):
    """Proofs of all documents against the root, some of them tampered with."""
    docs = _read(spark, sf_dir, "documents")
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest(*row, F.col("text"))
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(tampered, merkle.digest(*row, folded)).otherwise(leaf)
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), claim.alias("claim"))
    manifest = merkle.build(leaves, F.col("leaf"), "lang", ["doc_id"], keep=["doc_id", "claim"])
    return merkle.prove(manifest).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.col("claim"), F.col("path")).alias("folded_root"),
        (merkle.fold(F.col("claim"), F.col("path")) == F.col("root")).alias("verified"),
    )


def conversation_trie(spark, sf_dir):
    """The prefix trie of conversations that share up to five first turns by the hundred."""
    own = tries.paths(_read(spark, sf_dir, "conversations"))
    base = F.col("_c") - F.col("_c") % 100
    shared = F.crc32(F.col("_c").cast("string").cast("binary")) % 6
    return tries.trie(tries.rebuilt(sinks.materialize(own), base, shared, most=5))


def substring_dedup(spark, sf_dir):
    """What is there earlier too, in windows of 20 words."""
    found = windows.dedup(_read(spark, sf_dir, "documents"), length=20)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("starts").cast("long").alias("n_spans"))


QUERIES = {
    "op1_ngram_jaccard_join": jaccard_join,
    "op2_token_counts": token_counts,
    "op3_best_fit_packing": best_fit_packing,
    "op4_quality_rules": quality_rules,
    "op5_sentencepiece": sentencepiece,
    "op6_url_filters": url_filters,
    "op7_language_id": language_id,
    "op8_suffix_dedup": suffix_dedup,
    "op9_document_fingerprints": fingerprints,
    "op10_license_scans": license_scans,
    "op11_merkle_manifest": merkle_manifest,
    "op12_conversation_trie": conversation_trie,
    "op13_substring_dedup": substring_dedup,
}
