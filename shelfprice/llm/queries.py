"""The operators applied to the whole driver tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfprice.llm.conversations import damage, report_on_all
from shelfprice.llm.decontaminate import find_items
from shelfprice.llm.jaccard_join import similar_documents
from shelfprice.llm.language import identify_languages
from shelfprice.llm.lexical_search import search
from shelfprice.llm.lm_score import score_documents
from shelfprice.llm.packing import pack
from shelfprice.llm.pii import report
from shelfprice.llm.quality_model import score_quality
from shelfprice.llm.quality_rules import judge
from shelfprice.llm.substring_dedup import remove_repeated_passages
from shelfprice.llm.suffix_dedup import remove_repeated_bytes
from shelfprice.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


_WORDS = r"SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents"

_PASSAGES = f"""WITH w AS ({_WORDS}),
    starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w),
    windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS words FROM starts),
    seen AS (SELECT words, min(doc_id) AS earliest FROM windows GROUP BY words),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN seen USING (words) WHERE earliest < doc_id),
    numbered AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS words
        FROM numbered ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(words, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

_GROUPS = f"""WITH RECURSIVE w AS ({_WORDS}),
    sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5
        THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS shingles FROM w),
    classes AS (SELECT shingles, min(doc_id) AS rep, count(*) AS n_copies FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
    elements AS (SELECT rep, len(shingles) AS n, unnest(shingles) AS shingle FROM classes),
    links AS (SELECT a.rep AS rep, b.rep AS other FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.rep <> b.rep
        GROUP BY a.rep, b.rep, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))),
    reached AS (SELECT rep, rep AS other FROM classes
        UNION SELECT r.rep, l.other FROM reached r JOIN links l ON l.rep = r.other),
    found AS (SELECT rep, min(other) AS class_id FROM reached GROUP BY rep),
    degree AS (SELECT rep, count(*) AS n_links FROM links GROUP BY rep)
    SELECT s.doc_id, coalesce(f.class_id, s.doc_id) AS class_id, coalesce(c.n_copies, 1) AS n_copies, coalesce(d.n_links, 0) AS n_links
    FROM sets s LEFT JOIN classes c ON c.shingles = s.shingles AND len(s.shingles) > 0
    LEFT JOIN found f ON f.rep = c.rep LEFT JOIN degree d ON d.rep = c.rep"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_SEARCH = f"""WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
    own AS (SELECT doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
    corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM own),
    items AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
    asked AS (SELECT DISTINCT term FROM items),
    held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM own) SEMI JOIN asked USING (term) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, corpus GROUP BY term, n_docs),
    scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM held JOIN weights USING (term) JOIN items USING (term), corpus GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 20"""


def _plus(cell: str, cost: str, audit: str) -> str:
    """A cell (cost in six digits, then the audit, so that the least text is the least cell) with one more edit."""
    return f"CASE WHEN {cell} IS NOT NULL THEN lpad(CAST(CAST({cell}[1:6] AS INTEGER) + {cost} AS VARCHAR), 6, '0') || {cell}[7:] || '{audit}' END"


def _if(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


_BITS = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
_CODE = f"xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT))), lambda c, b: {_BITS}), 4294967295) % 20"
_KEPT = {r: [_if(f"i = '{r}' AND NOT gone", _plus(f"t{p}", "cut", "K")) for p in states] for r, states in {"s": (0,), "u": (0, 1, 3), "a": (2,)}.items()}
_CHANGED = {p: _if("NOT gone", _plus(f"t{p}", "2 + cut", "R")) for p in range(4)}

#: Row by row, the cheapest way to each state: nothing yet (0), after the system turn, a user, an assistant.
_REPAIR = f"""WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
    coded AS (SELECT conv_id, turn, role, text, {_CODE} AS code FROM named),
    damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
        FROM coded WHERE code <> 0),
    placed AS (SELECT conv_id, turn, role, text, role[1:1] AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS seen,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
    judged AS (SELECT *, seen = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
        lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM placed),
    rows AS (SELECT *, blank OR again AS gone, CAST(NOT blank AND NOT again AND seen[-1:] NOT IN ('.', '!', '?') AS INTEGER) AS cut FROM judged),
    faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (again AND NOT blank) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
    cells AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM faults
        UNION ALL SELECT conv_id, n, {_plus('t0', '3', 'D')}, least({_plus('t1', '3', 'D')}, {', '.join(_KEPT['s'])}),
            least({_plus('t2', '3', 'D')}, {', '.join([*_KEPT['u'], _CHANGED[0], _CHANGED[1], _CHANGED[3]])}),
            least({_plus('t3', '3', 'D')}, {', '.join([*_KEPT['a'], _CHANGED[2]])})
        FROM (SELECT r.conv_id, r.n, r.i, r.gone, r.cut, s0 AS t0, s1 AS t1,
                least(s2, {_plus('s0', '2', 'I')}, {_plus('s1', '2', 'I')}, {_plus('s3', '2', 'I')}) AS t2,
                least(s3, {_plus('s2', '2', 'I')}, {_plus('s0', '4', 'II')}, {_plus('s1', '4', 'II')}) AS t3
            FROM cells c JOIN rows r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.n = c.n + 1)),
    best AS (SELECT c.conv_id, least(s0, s3, {_plus('s2', '2', 'I')}, {_plus('s1', '4', 'II')}) AS cell
        FROM cells c JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.n = c.n),
    edits AS (SELECT conv_id, unnest(range(1, length(cell) - 5)) AS j, cell[7:] AS audit FROM best),
    steps AS (SELECT conv_id, j, audit[j:j] AS edit, count(*) FILTER (audit[j:j] <> 'I') OVER w AS n, count(*) FILTER (audit[j:j] <> 'D') OVER w AS k,
        count(*) FILTER (audit[j:j] <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
    turns AS (SELECT s.conv_id, j, CASE WHEN edit = 'K' THEN r.role WHEN (k - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
        CASE WHEN edit = 'I' THEN '' ELSE r.text END AS line
        FROM steps s LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.n = s.n WHERE edit <> 'D'),
    whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS lines FROM turns GROUP BY conv_id),
    every AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT e.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
        coalesce(f.illegal, 0) AS illegal, CAST(coalesce(b.cell[1:6], '0') AS BIGINT) AS cost, coalesce(b.cell[7:], '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
    FROM every e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM e.conv_id"""


@query("op1_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


@query("op2_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer())


@query("op4_substring_dedup", _PASSAGES)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op9_jaccard_join", _GROUPS)
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "n_links")


@query("op10_lm_score")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op12_lexical_search", _SEARCH)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_conversation_repair", _REPAIR)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return report_on_all(turns, damage(turns))
