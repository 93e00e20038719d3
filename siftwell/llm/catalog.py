"""Queries of the text operators over the driver's tables, with oracle SQL where SQL can tell."""

from __future__ import annotations

from siftwell.llm import capfilters, chat, langid, licenses, minhash, mixing, pieces, sharding, simhash, toxicity
from siftwell.session import read_table


def op1_minhash(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_chat(spark, sf_dir):
    """Every conversation, and the hostile one, formatted and read back."""
    messages = chat.with_hostile(read_table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(messages))


def op3_sentencepiece(spark, sf_dir):
    """All documents encoded and decoded."""
    return pieces.digests(read_table(spark, sf_dir, "documents"))


def op4_licenses(spark, sf_dir):
    """License phrases and notices of all documents."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op5_sharding(spark, sf_dir):
    """All documents in 16 shards that match the mixture."""
    out = sharding.shard(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_simhash(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return simhash.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op7_vectors(spark, sf_dir):
    """Near-duplicate components of all vectors."""
    return capfilters.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark, sf_dir):
    """Toxicity scores of all documents."""
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_language(spark, sf_dir):
    """Languages of all documents."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    """All documents mixed to source targets."""
    out = mixing.mixed_sizes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_chat": op2_chat,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_licenses": op4_licenses,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_vectors": op7_vectors,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
}

ORACLES = {
    "op1_minhash": minhash.SQL,
    "op2_chat": chat.SQL,
    "op4_licenses": licenses.SQL,
    "op5_sharding": sharding.SQL,
    "op7_vectors": capfilters.SQL,
    "op10_mixing": mixing.SQL,
}
