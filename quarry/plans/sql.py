"""DuckDB SQL fragments mirroring the Spark expressions (used by the oracle)."""

from __future__ import annotations

from quarry.functions.text import CONTROL_CLASS, WS_RUN
from quarry.plans.edge_rows import edge_sql

CTRL_SQL = CONTROL_CLASS
WS_SQL = WS_RUN


def nfc(x: str) -> str:
    return f"nfc_normalize({x})"


def strip_control(x: str) -> str:
    return f"regexp_replace({x}, '{CTRL_SQL}', '', 'g')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS_SQL}', ' ', 'g'))"


def normalize(x: str) -> str:
    return collapse_ws(strip_control(nfc(x)))


def is_blank(x: str) -> str:
    return f"(coalesce(regexp_replace({x}, '{WS_SQL}', '', 'g'), '') = '')"


def src_with_edges() -> str:
    """CTE body: documents (doc_id, text, lang, source) plus the edge rows."""
    return f"SELECT doc_id, text, lang, source FROM documents UNION ALL {edge_sql()}"


def classified(min_chars: int = 200, max_chars: int = 200_000, lang: str | None = None,
               src: str | None = None) -> str:
    """CTE chain ending in ``cls(doc_id, source, lang, norm_text, n_chars, doc_hash, reason)``."""
    src = src or src_with_edges()
    lang_case = f"WHEN coalesce(lang = '{lang}', false) = false THEN 'lang'" if lang else ""
    return f"""
src AS ({src}),
norm AS (SELECT doc_id, source, lang, {normalize('text')} AS norm_text FROM src),
pre AS (
  SELECT *, length(norm_text) AS n_chars, sha1(norm_text) AS doc_hash,
    CASE WHEN coalesce(norm_text, '') = '' THEN 'empty'
         WHEN length(norm_text) < {min_chars} THEN 'short'
         WHEN length(norm_text) > {max_chars} THEN 'long'
         {lang_case}
    END AS r0
  FROM norm),
win AS (SELECT *, min(CASE WHEN r0 IS NULL THEN doc_id END) OVER (PARTITION BY doc_hash) AS first_id FROM pre),
cls AS (
  SELECT doc_id, source, lang, norm_text, n_chars, doc_hash,
    coalesce(r0, CASE WHEN doc_id = first_id THEN 'kept' ELSE 'dup' END) AS reason
  FROM win)"""


def seeded_hash(seed: int, key: str) -> str:
    return f"sha1('{seed}:' || CAST({key} AS VARCHAR))"


def hash_uniform(h: str, start: int = 9) -> str:
    return f"(CAST(('0x' || substr({h}, {start}, 8)) AS UBIGINT) / CAST(4294967296 AS DOUBLE))"


def split_case(key: str, seed: int = 42, ratio: float = 0.05) -> str:
    return (f"CASE WHEN {hash_uniform(seeded_hash(seed, key))} < CAST({float(ratio)!r} AS DOUBLE) "
            f"THEN 'val' ELSE 'train' END")


def kept(min_chars: int = 200, max_chars: int = 200_000) -> str:
    """CTE chain ending in ``kept`` (rows that survive the preparation stage)."""
    return classified(min_chars, max_chars) + ",\nkept AS (SELECT * FROM cls WHERE reason = 'kept')"


def pairs() -> str:
    """CTE ``pairs(conv_id, turn, prompt, response)`` from conversations."""
    return ("pairs AS (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response "
            "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
            "AND a.role = 'assistant' WHERE u.role = 'user')")
