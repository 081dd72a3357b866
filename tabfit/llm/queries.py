"""The ``opN_<name>`` queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from tabfit.llm.fingerprint import op9_simhash
from tabfit.llm.html_extract import op7_html
from tabfit.llm.line_dedup import op8_line_dedup
from tabfit.llm.merkle import op12_merkle
from tabfit.llm.near_dedup import op4_minhash
from tabfit.llm.packing import op6_packing
from tabfit.llm.pii import op3_pii
from tabfit.llm.quality import op10_weak_quality
from tabfit.llm.resampling import op11_resampling
from tabfit.llm.sampling import op5_sentencepiece
from tabfit.llm.sharding import op1_jump_sharding
from tabfit.llm.substring_dedup import op13_substring_dedup
from tabfit.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_jump_sharding": op1_jump_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_minhash": op4_minhash,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_packing": op6_packing,
    "op7_html": op7_html,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash": op9_simhash,
    "op10_weak_quality": op10_weak_quality,
    "op11_resampling": op11_resampling,
    "op12_merkle": op12_merkle,
    "op13_substring_dedup": op13_substring_dedup,
    "pipeline": corpus_pipeline.run,
}

#: Lines of the first copy of every text; the shortest runs of 50 words from and to
#: each line; lines of runs that occur earlier go.
_OP8_SQL = r"""
WITH d AS (SELECT doc_id, text, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS fid FROM d GROUP BY t),
every AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS s,
                 unnest(range(len(string_split(t, chr(10))))) AS no FROM d),
counted AS (SELECT *, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w FROM every),
lines AS (SELECT doc_id, s, no, w, row_number() OVER p AS i, sum(w) OVER p AS ce, sum(w) OVER p - w AS cs
          FROM counted WHERE w > 0 AND doc_id IN (SELECT fid FROM firsts)
          WINDOW p AS (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING)),
framed AS (SELECT doc_id, i, count(*) OVER f AS n1, sum(w) OVER f AS w1, md5(list(s) OVER f::VARCHAR) AS k1,
                  count(*) OVER b AS n2, sum(w) OVER b AS w2, md5(list(s) OVER b::VARCHAR) AS k2
           FROM lines
           WINDOW f AS (PARTITION BY doc_id ORDER BY cs RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING),
                  b AS (PARTITION BY doc_id ORDER BY ce RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
runs AS (SELECT doc_id, i AS start, n1 AS n, k1 AS k FROM framed WHERE w1 >= 50
         UNION SELECT doc_id, i - n2 + 1, n2, k2 FROM framed WHERE w2 >= 50),
origin AS (SELECT k, min({'d': doc_id, 's': start}) AS o FROM runs GROUP BY k),
gone AS (SELECT DISTINCT r.doc_id, unnest(range(start, start + n)) AS i FROM runs r JOIN origin USING (k)
         WHERE {'d': r.doc_id, 's': r.start} > o),
placed AS (SELECT doc_id, i, no, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g
           FROM gone JOIN lines USING (doc_id, i)),
cuts AS (SELECT doc_id, g, min(no) AS lo, max(no) AS hi, count(*) AS n FROM placed GROUP BY doc_id, g),
cleaned AS (SELECT c.doc_id, coalesce(string_agg(c.s, chr(10) ORDER BY c.no), '') AS text
            FROM every c LEFT JOIN cuts x ON c.doc_id = x.doc_id AND c.no BETWEEN x.lo AND x.hi
            WHERE x.lo IS NULL AND c.doc_id IN (SELECT doc_id FROM cuts) GROUP BY c.doc_id),
removed AS (SELECT doc_id, sum(n) AS n FROM cuts GROUP BY doc_id),
size AS (SELECT doc_id, sum(w) AS w, count(*) FILTER (WHERE w > 0) AS n FROM counted GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN d.doc_id <> fid AND size.w >= 50 THEN '' WHEN removed.n IS NOT NULL THEN coalesce(cleaned.text, '')
            ELSE d.text END AS text,
       CAST(CASE WHEN d.doc_id <> fid THEN CASE WHEN size.w >= 50 THEN size.n ELSE 0 END
                 ELSE coalesce(removed.n, 0) END AS BIGINT) AS n_removed_lines
FROM d JOIN firsts USING (t) LEFT JOIN size ON size.doc_id = d.doc_id
LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN cleaned ON cleaned.doc_id = d.doc_id
"""

#: Two-word shingles of the distinct texts, links by an inverted index, and the
#: least id reachable over them.
_OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_sort(list_distinct(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM w),
cls AS (SELECT md5(s::VARCHAR) AS c, min(doc_id) AS rep, any_value(s) AS s, len(any_value(s)) AS n
        FROM s WHERE len(s) > 0 GROUP BY 1),
inv AS (SELECT rep, n, unnest(s) AS x FROM cls),
df AS (SELECT x, count(*) AS f FROM inv GROUP BY x),
ranked AS (SELECT rep, n, inv.x, row_number() OVER (PARTITION BY rep ORDER BY f, inv.x) AS r FROM inv JOIN df USING (x)),
prefix AS (SELECT * FROM ranked WHERE r <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1),
cand AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.rep < b.rep
         AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (SELECT a, b FROM cand JOIN cls p ON p.rep = a JOIN cls q ON q.rep = b
          WHERE 100 * len(list_intersect(p.s, q.s)) >= 80 * (p.n + q.n - len(list_intersect(p.s, q.s)))),
edges AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links),
reach AS (SELECT x, y FROM edges UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       coalesce(least(cls.rep, m), s.doc_id) AS component_id,
       s.doc_id = coalesce(least(cls.rep, m), s.doc_id) AS kept
FROM s LEFT JOIN cls ON len(s.s) > 0 AND cls.c = md5(s.s::VARCHAR) LEFT JOIN least ON least.x = cls.rep
"""

#: CRC-32 of the bytes of a string ``s`` by its table ``crc`` (fixed value: the reflected polynomial).
_CRC_TABLE = """crc AS (SELECT list(list_reduce([b] || range(8), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS crc FROM range(256) t(b))"""


def _crc(s: str) -> str:
    byte = f"CAST('0x' || hex(encode({s}))[2 * i + 1:2 * i + 2] AS BIGINT)"
    return (f"xor(list_reduce([4294967295] || list_transform(range(octet_length(encode({s}))), lambda i: {byte}), "
            "lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1])), 4294967295)")


_OP11_SQL = rf"""
WITH {_CRC_TABLE}, d AS (SELECT 0 AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
f AS (SELECT side, id, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i])
    || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS x FROM w),
n AS (SELECT side, id, x, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT x, CAST({_crc('x')} % 10000 AS BIGINT) AS b FROM (SELECT DISTINCT x FROM n), crc),
k AS (SELECT side, id, b, n FROM n JOIN b USING (x)),
st AS (SELECT b, coalesce(sum(n) FILTER (WHERE side = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0) AS t
    FROM k GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM st) + 10000) AS DOUBLE)
    / CAST((s + 1) * ((SELECT sum(t) FROM st) + 10000) AS DOUBLE))) AS BIGINT) AS g FROM st),
weight AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight
    FROM k JOIN g USING (b) WHERE side = 0 GROUP BY id),
scored AS (SELECT w.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || w.id)[1:8] AS BIGINT) + 0.5)
        / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score, len(w) >= 20 AS able
    FROM w LEFT JOIN weight USING (id) WHERE side = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS r,
    count(*) OVER (PARTITION BY able) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND r <= 5 * n // 100 THEN r END AS rank FROM placed
"""


def _value(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END")


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Nodes ``lvl, g, i, n, h`` of all levels of the trees over the nodes of ``{0}``.
_TREE = """(SELECT 0 AS lvl, * FROM {0} UNION ALL
    SELECT lvl + 1, g, i // 16, (n + 15) // 16, h FROM (
        SELECT lvl, g, i, n, sha256(string_agg(h, '') OVER (PARTITION BY g, i // 16 ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS h FROM {1} WHERE n > 1) WHERE i % 16 = 0)"""
#: The siblings of every node of ``{0}`` before and after it.
_SIBLINGS = """(SELECT lvl, g, i, n,
    coalesce(string_agg(h, '') OVER (PARTITION BY lvl, g, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY lvl, g, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {0} WHERE n > 1)"""
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP12_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, leaves AS (SELECT source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, {_leaf('text')} AS h FROM documents),
tree AS {_TREE.format('leaves', 'tree')},
sib AS {_SIBLINGS.format('tree')},
subs AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h FROM tree WHERE n = 1),
named AS (SELECT g AS source, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h AS subroot FROM tree WHERE n = 1),
top AS {_TREE.format('subs', 'top')},
topsib AS {_SIBLINGS.format('top')},
docs AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS start,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents, crc),
up AS (SELECT doc_id, source, leaf, start AS cur, i, 0 AS lvl, '' AS proof, false AS top, false AS done FROM docs
    UNION ALL
    SELECT doc_id, up.source, leaf, CASE WHEN a.l IS NOT NULL THEN sha256(a.l || cur || a.r)
            WHEN b.l IS NOT NULL THEN sha256(b.l || cur || b.r) ELSE cur END,
        CASE WHEN top THEN up.i // 16 WHEN a.l IS NOT NULL THEN up.i // 16 ELSE named.i END,
        CASE WHEN NOT top AND a.l IS NULL THEN 0 ELSE up.lvl + 1 END,
        proof || coalesce(a.l || a.r, b.l || b.r, ''), top OR a.l IS NULL, top AND b.l IS NULL
    FROM up JOIN named ON up.source IS NOT DISTINCT FROM named.source
    LEFT JOIN sib a ON NOT top AND a.lvl = up.lvl AND a.g IS NOT DISTINCT FROM up.source AND a.i = up.i
    LEFT JOIN topsib b ON top AND b.lvl = up.lvl AND b.i = up.i WHERE NOT done)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root.h AS verified
FROM up JOIN named ON up.source IS NOT DISTINCT FROM named.source, (SELECT h FROM top WHERE n = 1) root WHERE done
"""

#: All windows of 20 words by hash; words of windows that are not the first of their hash go.
_OP13_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest(list_transform(range(1, len(w) - 18),
    lambda i: md5(array_to_string(w[i:i + 19], ' ')))) AS k FROM w WHERE len(w) >= 20),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
per AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w WHERE doc_id IN (SELECT doc_id FROM per)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.t, '') END) AS kept_sha256
FROM w LEFT JOIN per USING (doc_id) LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

ORACLES: dict[str, str] = {"op4_minhash": _OP4_SQL, "op8_line_dedup": _OP8_SQL, "op11_resampling": _OP11_SQL,
                           "op12_merkle": _OP12_SQL, "op13_substring_dedup": _OP13_SQL}
