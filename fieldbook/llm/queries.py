"""The registered queries of the text operators: tables in, contract columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bpe, decontamination, extraction, imatch, masked_lm, merkle, neighbours, nnpu, oracles, packing, partenum, prefix_trie, secret_scan, string_kernel, suffix_dedup
from fieldbook.llm.common import held_out, table, training_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op2_secret_scan": oracles.SECRETS, "op3_partenum_join": oracles.SIMILAR, "op11_prefix_trie": oracles.TRIE, "op13_merkle_manifest": oracles.MANIFEST}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are.

    Documents with equal ids follow each other by text. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lexicon = imatch.lexicon(docs)
    pairs = neighbours.with_next(docs, "doc_id", "text", "next_text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    both = pairs.withColumn("edited", edited).drop("next_text")
    both = imatch.fingerprints(imatch.fingerprints(both, lexicon, "text", "own"), lexicon, "edited", "changed")
    measured = both.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "own",
        "changed",
        neighbours.following("own").alias("next"),
        neighbours.IS_COPY,
    )
    return measured.where(~F.col(neighbours.IS_COPY)).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        imatch.as_text(F.col("own")).alias("fingerprint"),
        imatch.as_text(F.col("changed")).alias("edited_fingerprint"),
        imatch.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        imatch.likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document; the source is the owner, (source, language) the repository."""
    docs = table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    found = secret_scan.find_secrets(docs, owner=F.col("source"), repository=repository)
    entries = F.col("found")
    return found.select(
        "doc_id",
        *[secret_scan.counted(entries, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(entries, base_only=True), 256).alias("base_sha256"),
        secret_scan.listed(entries).alias("spans"),
        secret_scan.counted(entries, secret_scan.LIVE).alias("n_live"),
        F.size(F.filter(entries, lambda x: x["judged"] == "example")).cast("bigint").alias("n_examples"),
        *[F.coalesce(F.array_max(F.col(f"found.n_{n}")), F.lit(0)).cast("bigint").alias(f"most_{n}") for n in ("owners", "repositories")],
    )


@query
def op3_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose shingle sets link."""
    return partenum.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op4_nnpu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; trusted positives are labels of the training folds."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = nnpu.train(docs, labels, training_fold(F.col("doc_id")) & (F.col("quality") == 1))
    return nnpu.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 100 bytes leave of every document."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the training folds alone are learnt."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = training_fold(F.col("doc_id"))
    machine = string_kernel.train(docs, labels, fold & (F.col("toxic") == 1), fold & (F.col("toxic") == 0))
    return string_kernel.score(docs, machine).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that they hold."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; length in code points."""
    pages = extraction.extract_pages(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public byte-level vocabulary; digests of ids and decoded text."""
    return token_digests(bpe.tokenise(table(spark, sf_dir, "documents"), byte_bpe_path()))


@query
def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under the network fitted on the whole table."""
    docs = table(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.train(docs))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


@query
def op12_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents by binary length; a sequence is one piece, so its offset is 0 and nothing is padded."""
    packed = packing.pack(table(spark, sf_dir, "documents"), byte_bpe_path())
    return packed.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", F.lit(0).cast("bigint").alias("offset")
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the trees of the languages, and the root that its (for one in seven altered) content folds to."""
    docs = table(spark, sf_dir, "documents")
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    ident, more = merkle.field(F.col("doc_id"), is_text=False), F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    leaf = lambda n: merkle.digest_of(
        [ident, *[merkle.field(F.col(c)) for c in ("source", "lang")], merkle.field(n, is_text=False), merkle.field(F.col("text"))]
    )
    rows = docs.withColumn("_leaf", leaf(F.col("n_chars")))
    rows = rows.withColumn("_claimed", F.when(changed & F.col("n_chars").isNotNull(), leaf(more)).otherwise(F.col("_leaf")))
    proofs = merkle.manifest(rows, "lang", ["doc_id"], "_leaf", "_claimed", ["doc_id"])
    return proofs.select(
        "doc_id",
        *[merkle.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.hexed(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        merkle.hexed(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def token_digests(tokens: DataFrame, *more: str) -> DataFrame:
    return tokens.select(
        "doc_id",
        "n_tokens",
        *more,
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
