"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import centroids, chat, codes, language, lines, media, minhash, mixing, pieces, quality, simhash, surrogates, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_media_columns": media.op2_media_columns,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_sentencepiece": pieces.op4_sentencepiece,
    "op5_pii": surrogates.op5_pii,
    "op6_simhash": simhash.op6_simhash,
    "op7_quality": quality.op7_quality,
    "op8_mixing": mixing.op8_mixing,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_fingerprints": minhash.op10_fingerprints,
    "op11_language": language.op11_language,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_centroids": centroids.op13_centroids,
}
SQL = {
    "op3_chat_formatting": chat.OP3_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op9_line_dedup": lines.OP9_SQL,
    "op12_vector_codes": codes.OP12_SQL,
    "op13_centroids": centroids.OP13_SQL,
}
