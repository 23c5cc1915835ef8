"""Explicit table schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
_AUTHORS = T.ArrayType(_S, True)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CITATION = (("paper_id", _S), ("paper_version", _S), ("title", _S), ("authors", _AUTHORS),
            ("published", _S), ("pdf_url", _S))
PAPERS = _struct(*CITATION, ("source_path", _S))
SEARCH_PAPERS = _struct(*CITATION, ("source_path", _S), ("categories", T.ArrayType(_S, True)),
                        ("url", _S), ("abstract", _S))
PAGES = _struct(*CITATION, ("page_number", _L), ("text", _S))
SOURCES = _struct(("paper_id", _S), ("source_path", _S), ("sha256", _S), ("reader", _S),
                  ("reader_version", _S), ("status", _S))
CHUNKS = _struct(("schema_version", T.IntegerType()), ("chunk_id", _S), *CITATION,
                 ("page_number", _L), ("text", _S), ("start_character", _L),
                 ("end_character", _L), ("page_text_sha256", _S),
                 ("chunking_profile_sha256", _S), ("content_token_count", _L),
                 ("input_token_count", _L))
VECTOR = T.ArrayType(T.FloatType(), True)
PAPER_VECTORS = _struct(("id", _S), ("document", _S), ("paper_id", _S), ("title", _S),
                        ("url", _S), ("published", _S), ("generation", _S),
                        ("embedding_model", _S), ("embedding_fingerprint", _S),
                        ("embedding", VECTOR))
CHUNK_VECTORS = _struct(("id", _S), ("document", _S), ("paper_id", _S), ("page_number", _L),
                        ("start_character", _L), ("end_character", _L),
                        ("page_text_sha256", _S), ("chunking_profile_sha256", _S),
                        ("title", _S), ("pdf_url", _S), ("generation", _S),
                        ("embedding_model", _S), ("embedding_fingerprint", _S),
                        ("embedding", VECTOR))
CONVERSATIONS = _struct(("id", _S), ("title", _S), ("created_at", T.TimestampType()),
                        ("updated_at", T.TimestampType()))
MESSAGES = _struct(("conversation_id", _S), ("seq", _L), ("role", _S), ("content", _S),
                   ("created_at", T.TimestampType()), ("retrievals", _S))
EVIDENCE = _struct(("question_id", _S), ("paper_id", _S), ("page", _L), ("text", _S))
VIOLATIONS = _struct(("rule", _S), ("key", _S), ("detail", _S))
