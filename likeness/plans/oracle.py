"""DuckDB text for the oracle check.  Each query is written independently
of the Spark plan: brute force where the Spark plan is clever (no exact-copy
compaction, per-pair expansion, plain windows)."""

from __future__ import annotations

from likeness.functions.hashing import (MERSENNE_PRIME, NUM_BANDS, ROWS_PER_BAND, WIDE_PRIME, minhash_params,
                                        wide_params)
from likeness.operators.sets import CHUNK_SIZE
from likeness.operators.toppairs import THRESHOLDS, TOP_K


def _h(x: str) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 7))::BIGINT"


def _h60(x: str) -> str:
    return f"('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15))::BIGINT"


def _perms() -> str:
    rows = ", ".join(f"({i}, {a}::BIGINT, {b}::BIGINT)" for i, (a, b) in enumerate(minhash_params()))
    return f"perms(perm, a, b) AS (VALUES {rows})"


DOC_TERMS = """doc_terms AS (
  SELECT user_id, item, count(*)::DOUBLE AS rating FROM (
    SELECT CAST(doc_id AS BIGINT) AS user_id, unnest(string_split(text, ' ')) AS item
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL) w
  GROUP BY user_id, item)"""

ORDER_LINES = """order_lines AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id, CAST(l.l_partkey AS BIGINT) AS item_id,
         l.l_quantity, l.l_returnflag
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL)"""

RATINGS_RAW = ORDER_LINES + """,
ratings_raw AS (
  SELECT user_id, item_id, ceil(l_quantity / 5.0) / 2.0 AS rating FROM order_lines)"""

RATINGS = ORDER_LINES + """,
ratings AS (
  SELECT user_id, item_id, ceil(avg(l_quantity) / 5.0) / 2.0 AS rating
  FROM order_lines GROUP BY user_id, item_id)"""

RATINGS_AND_TAGS = RATINGS + """,
tags AS (SELECT DISTINCT user_id, item_id FROM order_lines WHERE l_returnflag = 'R')"""


def _signatures(src: str = "doc_terms", entity: str = "user_id", item: str = "item") -> str:
    """sig_long (id, perm, h), ent (id, n), sig (id, s LIST)."""
    return f"""{_perms()},
eh AS (SELECT {entity} AS id, {_h(item)} AS h FROM {src}),
sig_long AS (
  SELECT e.id, p.perm, min((e.h * p.a + p.b) % {MERSENNE_PRIME}) AS h
  FROM eh e CROSS JOIN perms p GROUP BY e.id, p.perm),
ent AS (SELECT {entity} AS id, count(*) AS n FROM {src} GROUP BY {entity}),
sig AS (SELECT id, list(h ORDER BY perm) AS s FROM sig_long GROUP BY id)"""


def _wide_signatures(src: str, entity: str, item: str) -> str:
    """Like ``_signatures``, over 60-bit hashes modulo 2^61 - 1."""
    rows = ", ".join(f"({i}, {a}::HUGEINT, {b}::HUGEINT)" for i, (a, b) in enumerate(wide_params()))
    return f"""perms(perm, a, b) AS (VALUES {rows}),
eh AS (SELECT DISTINCT {entity} AS id, {_h60(item)} AS h FROM {src}),
sig_long AS (
  SELECT e.id, p.perm, min((e.h::HUGEINT * p.a + p.b) % {WIDE_PRIME}::HUGEINT)::BIGINT AS h
  FROM eh e CROSS JOIN perms p GROUP BY e.id, p.perm),
ent AS (SELECT {entity} AS id, count(*) AS n FROM {src} GROUP BY {entity}),
sig AS (SELECT id, list(h ORDER BY perm) AS s FROM sig_long GROUP BY id)"""


def _bands(src: str, id_col: str, name: str) -> str:
    r = ROWS_PER_BAND
    return f"""{name} AS (
  SELECT {id_col} AS id, j AS band, s[{r} * j + 1 : {r} * j + {r}] AS k
  FROM {src}, range({NUM_BANDS}) t(j))"""


def _candidates(bands: str, name: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT l.id AS id1, r.id AS id2 FROM {bands} l JOIN {bands} r
  ON l.band = r.band AND l.k = r.k AND l.id < r.id)"""


def _scored(cand: str, name: str) -> str:
    return f"""{name} AS (
  SELECT c.id1, c.id2,
         (count(*) FILTER (WHERE a.h = b.h))::DOUBLE / count(*) AS estimated_jaccard
  FROM {cand} c JOIN sig_long a ON a.id = c.id1
  JOIN sig_long b ON b.id = c.id2 AND b.perm = a.perm
  GROUP BY c.id1, c.id2)"""


def _groups() -> str:
    return """grp AS (SELECT s, min(id) AS group_id, count(*) AS group_size FROM sig GROUP BY s),
reps AS (SELECT group_id, s FROM grp)"""


def _th() -> str:
    rows = ", ".join(f"({t})" for t in THRESHOLDS)
    return f"th(min_ratings) AS (VALUES {rows})"


def similarity_brute_force() -> str:
    """All entities banded, no compaction: the expanded candidate list."""
    return ",\n".join([DOC_TERMS, _signatures(), _bands("sig", "id", "bands"),
                       _candidates("bands", "cand"), _scored("cand", "scored")])


def similarity_by_group() -> str:
    """The expanded pairs, each named by the copy groups of its members."""
    return ",\n".join([similarity_brute_force(), _groups()]) + """,
named AS (
  SELECT least(g1.group_id, g2.group_id) AS group1, greatest(g1.group_id, g2.group_id) AS group2,
         sc.estimated_jaccard
  FROM scored sc JOIN sig a ON a.id = sc.id1 JOIN grp g1 ON g1.s = a.s
  JOIN sig b ON b.id = sc.id2 JOIN grp g2 ON g2.s = b.s)"""


PART_SIZES = ORDER_LINES + """,
part_sizes AS (SELECT user_id, CAST(p_size AS BIGINT) AS item FROM order_lines JOIN part ON p_partkey = item_id
               WHERE p_size IS NOT NULL)"""


def users_brute_force() -> str:
    """All users banded, over wide signatures."""
    return ",\n".join([PART_SIZES, _wide_signatures("part_sizes", "user_id", "item"), _bands("sig", "id", "bands"),
                       _candidates("bands", "cand"), _scored("cand", "scored")])


def top_pairs_sql(source: str | None = None) -> str:
    return "WITH " + ",\n".join([source or similarity_brute_force(), _th()]) + f""",
top AS (
  SELECT t.min_ratings::BIGINT AS min_ratings,
         row_number() OVER (PARTITION BY t.min_ratings
                            ORDER BY s.estimated_jaccard DESC, s.id1, s.id2) AS rank,
         s.id1, s.id2, s.estimated_jaccard, e1.n AS n1, e2.n AS n2
  FROM scored s JOIN ent e1 ON e1.id = s.id1 JOIN ent e2 ON e2.id = s.id2
  JOIN th t ON e1.n > t.min_ratings AND e2.n > t.min_ratings)
SELECT min_ratings, rank::BIGINT AS rank, id1, id2, round(estimated_jaccard, 7) AS estimated_jaccard,
       n1::BIGINT AS n1, n2::BIGINT AS n2
FROM top WHERE rank <= {TOP_K}"""


def _idcg(n: str) -> str:
    return f"coalesce(list_sum(list_transform(range(1, ({n}) + 1), lambda i: 1.0 / log2(i + 1))), 0.0)"


def _split_cte(src: str, item: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn, n),
         CASE WHEN rn <= n * 8 // 10 THEN 'train' WHEN rn <= n * 9 // 10 THEN 'val'
              ELSE 'test' END AS split
  FROM (SELECT *,
          row_number() OVER (PARTITION BY user_id ORDER BY
            md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST({item} AS VARCHAR)), {item}) AS rn,
          count(*) OVER (PARTITION BY user_id) AS n
        FROM {src}) x
  WHERE n >= 5)"""


def _top_pairs_at(t: int) -> str:
    """checked (id1, id2): top-100 brute-force pairs with both counts > t."""
    return similarity_brute_force() + f""",
checked AS (
  SELECT s.id1, s.id2 FROM scored s JOIN ent e1 ON e1.id = s.id1 JOIN ent e2 ON e2.id = s.id2
  WHERE e1.n > {t} AND e2.n > {t}
  QUALIFY row_number() OVER (ORDER BY s.estimated_jaccard DESC, s.id1, s.id2) <= {TOP_K})"""


def _common(pairs: str, keys: str, name: str) -> str:
    ks = ", ".join(f"p.{k}" for k in keys.split(", "))
    return f"""{name} AS (
  SELECT {ks}, a.item, a.rating AS r1, b.rating AS r2
  FROM {pairs} p JOIN doc_terms a ON a.user_id = p.id1
  JOIN doc_terms b ON b.user_id = p.id2 AND b.item = a.item)"""


def _corr(pairs: str, common: str, keys: str, name: str) -> str:
    ks = ", ".join(f"p.{k}" for k in keys.split(", "))
    on = " AND ".join(f"c.{k} = p.{k}" for k in keys.split(", "))
    return f"""{name}_g AS (
  SELECT {keys}, count(*) AS n_common, min(r1) AS lo1, max(r1) AS hi1, min(r2) AS lo2,
         max(r2) AS hi2, corr(r1, r2) AS r, bool_and(r1 = r2) AS same
  FROM {common} GROUP BY {keys}),
{name}_s AS (
  SELECT {keys}, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT {keys}, item, row_number() OVER (PARTITION BY {keys} ORDER BY item) AS rk
        FROM {common}) z WHERE rk <= 10 GROUP BY {keys}),
{name} AS (
  SELECT {ks}, coalesce(c.n_common, 0)::BIGINT AS n_common,
         CASE WHEN coalesce(c.n_common, 0) <= 1 THEN 'too_few'
              WHEN c.lo1 = c.hi1 THEN 'constant_user1'
              WHEN c.lo2 = c.hi2 THEN 'constant_user2' ELSE 'ok' END AS status,
         c.r AS r_raw, coalesce(c.same, false) AS identical_ratings, s.items AS items
  FROM (SELECT DISTINCT {keys} FROM {pairs}) p LEFT JOIN {name}_g c ON {on}
  LEFT JOIN {name}_s s ON {on.replace('c.', 's.')})"""


def _random_pairs_sql(n_draws: int = 2000, trials: int = 20, k: int = 100) -> str:
    hh = _h60
    return f"""elig AS (SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx
  FROM (SELECT user_id FROM doc_terms GROUP BY user_id HAVING count(*) > 1) e),
nn AS (SELECT count(*) AS n FROM elig),
dr AS (
  SELECT r // {n_draws} AS trial, r % {n_draws} AS draw,
         {hh("'42:' || CAST(r // " + str(n_draws) + " AS VARCHAR) || ':' || CAST(r % " + str(n_draws) + " AS VARCHAR) || ':a'")} % nn.n AS i1,
         {hh("'42:' || CAST(r // " + str(n_draws) + " AS VARCHAR) || ':' || CAST(r % " + str(n_draws) + " AS VARCHAR) || ':b'")} % (nn.n - 1) AS j2
  FROM range({trials * n_draws}) t(r), nn),
dr2 AS (SELECT trial, draw, i1, CASE WHEN j2 >= i1 THEN j2 + 1 ELSE j2 END AS i2 FROM dr),
rp_all AS (
  SELECT trial, min(draw) AS draw, least(a.id, b.id) AS id1, greatest(a.id, b.id) AS id2
  FROM dr2 JOIN elig a ON a.idx = dr2.i1 JOIN elig b ON b.idx = dr2.i2
  GROUP BY trial, least(a.id, b.id), greatest(a.id, b.id)),
rp AS (SELECT trial, draw, id1, id2 FROM rp_all
  QUALIFY row_number() OVER (PARTITION BY trial ORDER BY draw) <= {k})"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["minhash_signatures"] = "WITH " + ",\n".join([DOC_TERMS, _signatures()]) + """
SELECT id, perm::BIGINT AS perm, h FROM sig_long"""
    q["signature_groups"] = "WITH " + ",\n".join([DOC_TERMS, _signatures(), _groups()]) + """
SELECT sig.id, ent.n::BIGINT AS n, grp.group_id, grp.group_size::BIGINT AS group_size
FROM sig JOIN grp USING (s) JOIN ent ON ent.id = sig.id"""
    q["lsh_candidates"] = "WITH " + similarity_by_group() + """
SELECT DISTINCT group1, group2 FROM named"""
    q["similar_pairs"] = "WITH " + similarity_by_group() + """
SELECT n.group1, n.group2, round(min(n.estimated_jaccard), 7) AS estimated_jaccard,
       min(a.group_size)::BIGINT AS size1, min(b.group_size)::BIGINT AS size2, count(*)::BIGINT AS n_pairs
FROM named n JOIN grp a ON a.group_id = n.group1 JOIN grp b ON b.group_id = n.group2
GROUP BY n.group1, n.group2"""
    q["pairs_per_threshold"] = "WITH " + ",\n".join([similarity_brute_force(), _th()]) + f"""
SELECT t.min_ratings::BIGINT AS min_ratings, count(s.id1)::BIGINT AS n_pairs,
       least(count(s.id1), {TOP_K})::BIGINT AS n_kept
FROM th t LEFT JOIN (
  SELECT s.id1, e1.n AS n1, e2.n AS n2 FROM scored s
  JOIN ent e1 ON e1.id = s.id1 JOIN ent e2 ON e2.id = s.id2) s
  ON s.n1 > t.min_ratings AND s.n2 > t.min_ratings
GROUP BY t.min_ratings"""
    q["top_pairs_by_threshold"] = top_pairs_sql()
    q["csv_roundtrip"] = ("SELECT id1, id2, estimated_jaccard, n1, n2 FROM (" + top_pairs_sql()
                          + ") r WHERE min_ratings = 50")

    q["user_signatures"] = "WITH " + PART_SIZES + ",\n" + _wide_signatures("part_sizes", "user_id", "item") + """
SELECT id, perm::BIGINT AS perm, h FROM sig_long"""
    q["similar_users"] = top_pairs_sql(users_brute_force())

    # the ratings file: what its good lines hold, and the faults of the others
    csv_lines = """WITH file_lines AS (
  SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS item_id,
         ceil(l_quantity / 5.0) / 2.0 AS rating, (l_orderkey * 7 + l_linenumber) % 41 AS fault
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL)"""
    q["ratings_from_csv"] = csv_lines + """
SELECT user_id, item_id, rating FROM file_lines WHERE fault NOT BETWEEN 1 AND 5"""
    q["ratings_csv_rejects"] = csv_lines + """
SELECT CASE WHEN fault = 5 THEN 'fields' WHEN fault = 1 THEN 'userId' WHEN fault = 2 THEN 'movieId'
            ELSE 'rating' END AS reason, count(*)::BIGINT AS n_lines
FROM file_lines WHERE fault BETWEEN 1 AND 5 GROUP BY 1"""

    # item sets over every order line
    q["grouped_items"] = "WITH " + RATINGS_RAW + f""",
per_item AS (SELECT user_id, item_id, count(*) AS c FROM ratings_raw GROUP BY 1, 2),
firsts AS (SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS first_items
  FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rk
        FROM per_item) z WHERE rk <= 10 GROUP BY user_id)
SELECT p.user_id, sum(c)::BIGINT AS n_rows, count(*)::BIGINT AS n_items,
       sum({_h('item_id')})::BIGINT AS items_digest, f.first_items
FROM per_item p JOIN firsts f USING (user_id) GROUP BY p.user_id, f.first_items"""
    q["item_lists"] = "WITH " + RATINGS_RAW + f""",
per_item AS (SELECT user_id, item_id, count(*) AS c FROM ratings_raw GROUP BY 1, 2),
chunks AS (SELECT user_id, (count(*) + {CHUNK_SIZE - 1}) // {CHUNK_SIZE} AS k FROM per_item GROUP BY user_id)
SELECT user_id, ({_h('item_id')} % k)::BIGINT AS chunk,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
       string_agg(CAST(c AS VARCHAR), ',' ORDER BY item_id) AS times
FROM per_item JOIN chunks USING (user_id) GROUP BY 1, 2"""
    q["grouped_audit"] = "WITH " + RATINGS_RAW + """,
g AS (SELECT user_id, count(DISTINCT item_id) AS n_items FROM ratings_raw GROUP BY user_id)
SELECT count(DISTINCT user_id)::BIGINT AS unique_users, count(*)::BIGINT AS row_count,
       count(*) FILTER (WHERE n_items IS NULL OR n_items = 0)::BIGINT AS null_lists,
       (count(DISTINCT user_id) = count(*)
        AND count(*) FILTER (WHERE n_items IS NULL OR n_items = 0) = 0) AS ok
FROM g"""

    # pair checks
    checked = "WITH " + _top_pairs_at(50)
    q["pair_validation"] = checked + """,
bounds AS (SELECT min(user_id) AS lo, max(user_id) AS hi FROM doc_terms),
vp AS (SELECT id1, id2 FROM checked
       UNION SELECT lo, hi + 1 FROM bounds UNION SELECT hi + 1, hi + 2 FROM bounds),
sz AS (SELECT user_id AS id, count(DISTINCT item) AS n FROM doc_terms GROUP BY 1),
smp AS (SELECT id, string_agg(item, ',' ORDER BY item) AS sample FROM (
          SELECT id, item, row_number() OVER (PARTITION BY id ORDER BY item) AS rk
          FROM (SELECT DISTINCT user_id AS id, item FROM doc_terms) d
          WHERE id IN (SELECT id1 FROM vp UNION SELECT id2 FROM vp)) z
        WHERE rk <= 10 GROUP BY id),
cm AS (SELECT p.id1, p.id2, count(*) AS k FROM vp p
       JOIN (SELECT DISTINCT user_id, item FROM doc_terms) a ON a.user_id = p.id1
       JOIN (SELECT DISTINCT user_id, item FROM doc_terms) b ON b.user_id = p.id2 AND b.item = a.item
       GROUP BY 1, 2)
SELECT p.id1, p.id2, s1.n IS NOT NULL AS exists1, s2.n IS NOT NULL AS exists2,
       coalesce(s1.n, 0)::BIGINT AS n1, coalesce(s2.n, 0)::BIGINT AS n2,
       coalesce(cm.k, 0)::BIGINT AS common,
       (coalesce(cm.k, 0) = coalesce(s1.n, 0) AND coalesce(cm.k, 0) = coalesce(s2.n, 0)) AS same_set,
       round(CASE WHEN coalesce(s1.n, 0) + coalesce(s2.n, 0) = 0 THEN 0.0
             ELSE coalesce(cm.k, 0) / (coalesce(s1.n, 0) + coalesce(s2.n, 0) - coalesce(cm.k, 0)) END,
             6) AS jaccard,
       coalesce(m1.sample, '') AS sample1, coalesce(m2.sample, '') AS sample2
FROM vp p LEFT JOIN sz s1 ON s1.id = p.id1 LEFT JOIN sz s2 ON s2.id = p.id2
LEFT JOIN cm ON cm.id1 = p.id1 AND cm.id2 = p.id2
LEFT JOIN smp m1 ON m1.id = p.id1 LEFT JOIN smp m2 ON m2.id = p.id2"""
    q["pair_common_ratings"] = checked + ",\n" + _common("checked", "id1, id2", "cmn") + """
SELECT id1, id2, item, r1, r2 FROM cmn"""
    pc = checked + ",\n" + _common("checked", "id1, id2", "cmn") + ",\n" + _corr(
        "checked", "cmn", "id1, id2", "pc")
    q["pair_correlation"] = pc + """
SELECT id1, id2, n_common, status, round(CASE WHEN status = 'ok' THEN r_raw END, 6) AS corr,
       coalesce(status = 'ok' AND r_raw >= 1 - 1e-9, false) AS perfect_corr, identical_ratings,
       CASE WHEN status LIKE 'constant%' THEN items END AS constant_items
FROM pc"""
    q["pair_noted_ratings"] = pc + """
SELECT id1, id2, status, coalesce(status = 'ok' AND r_raw >= 1 - 1e-9, false) AS perfect_corr, item, r1, r2
FROM pc JOIN cmn USING (id1, id2) WHERE status LIKE 'constant%' OR (status = 'ok' AND r_raw >= 1 - 1e-9)"""
    q["avg_pair_correlation"] = pc + """
SELECT count(*)::BIGINT AS n_pairs, round(avg(r_raw), 6) AS avg_corr FROM pc WHERE status = 'ok'"""

    # random control group
    q["eligible_users"] = "WITH " + RATINGS_RAW + """
SELECT user_id, count(*)::BIGINT AS n_rows FROM ratings_raw GROUP BY user_id HAVING count(*) > 1"""
    rnd = "WITH " + DOC_TERMS + ",\n" + _random_pairs_sql()
    q["random_pairs"] = rnd + "\nSELECT trial::BIGINT AS trial, draw::BIGINT AS draw, id1, id2 FROM rp"
    q["random_pair_baseline"] = rnd + ",\n" + _common("rp", "trial, id1, id2", "rc") + ",\n" + _corr(
        "rp", "rc", "trial, id1, id2", "rpc") + """,
pt AS (SELECT trial, count(*) AS n_pairs, avg(r_raw) AS a FROM rpc WHERE status = 'ok' GROUP BY trial),
tt AS (SELECT t.r AS trial, coalesce(pt.n_pairs, 0) AS n_pairs, coalesce(pt.a, 0.0) AS a
       FROM range(20) t(r) LEFT JOIN pt ON pt.trial = t.r)
SELECT trial::BIGINT AS trial, n_pairs::BIGINT AS n_pairs, round(a, 6) AS avg_corr,
       round((SELECT sum(a) FROM tt) / 20.0, 6) AS final_corr
FROM tt"""

    # split
    sp = "WITH " + RATINGS + ",\n" + _split_cte("ratings", "item_id", "sp")
    q["split_assignment"] = sp + "\nSELECT user_id, item_id, split FROM sp"
    q["split_summary"] = sp + """
SELECT split, count(*)::BIGINT AS n_rows, count(DISTINCT user_id)::BIGINT AS n_users
FROM sp GROUP BY split"""
    q["enriched_split"] = sp + "\nSELECT user_id, item_id, split, rating FROM sp"
    tsp = "WITH " + RATINGS_AND_TAGS + ",\n" + _split_cte("ratings", "item_id", "sp") + """,
tsp AS (SELECT sp.*, CAST(CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS tagged
        FROM sp LEFT JOIN tags t USING (user_id, item_id))"""
    q["tagged_split"] = tsp + "\nSELECT user_id, item_id, split, rating, tagged FROM tsp"

    # popularity and ranking
    stats = sp + """,
stats AS (SELECT item_id, sum(rating) AS rating_sum, count(*) AS rating_count
          FROM sp WHERE split = 'train' GROUP BY item_id)"""
    q["item_stats"] = stats + """
SELECT item_id, rating_sum, rating_count::BIGINT AS rating_count FROM stats"""
    q["popularity_topk"] = stats + """
SELECT b.beta::BIGINT AS beta,
       row_number() OVER (PARTITION BY b.beta ORDER BY s.rating_sum / (s.rating_count + b.beta) DESC,
                          s.item_id)::BIGINT AS rank,
       s.item_id, round(s.rating_sum / (s.rating_count + b.beta), 6) AS score
FROM stats s, (VALUES (250), (500)) b(beta)
QUALIFY rank <= 100"""
    sweep = stats + f""",
betas AS (SELECT range AS beta FROM range(250, 501)),
lists AS (
  SELECT b.beta, s.item_id AS item,
         row_number() OVER (PARTITION BY b.beta ORDER BY s.rating_sum / (s.rating_count + b.beta) DESC,
                            s.item_id) AS rank
  FROM stats s, betas b QUALIFY rank <= 100),
truth AS (SELECT DISTINCT user_id, item_id AS item FROM sp WHERE split = 'val'),
nu AS (SELECT count(DISTINCT user_id) AS n FROM truth),
hits AS (SELECT l.beta, t.user_id, count(*) AS h, sum(1.0 / log2(l.rank + 1)) AS dcg
         FROM truth t JOIN lists l ON l.item = t.item GROUP BY 1, 2),
sw AS (SELECT b.beta, coalesce(sum(h.dcg / {_idcg('h.h')}), 0.0) / (SELECT n FROM nu) AS ndcg
       FROM betas b LEFT JOIN hits h ON h.beta = b.beta GROUP BY b.beta)"""
    q["beta_sweep"] = sweep + "\nSELECT beta::BIGINT AS beta, round(ndcg, 6) AS ndcg FROM sw"
    q["best_beta_test"] = sweep + f""",
best AS (SELECT beta, ndcg FROM sw ORDER BY round(ndcg, 12) DESC, beta LIMIT 1),
tlist AS (SELECT item, rank FROM lists WHERE beta = (SELECT beta FROM best)),
ttruth AS (SELECT DISTINCT user_id, item_id AS item FROM sp WHERE split = 'test'),
thits AS (SELECT t.user_id, count(*) AS h, sum(1.0 / log2(l.rank + 1)) AS dcg
          FROM ttruth t JOIN tlist l ON l.item = t.item GROUP BY 1)
SELECT beta::BIGINT AS best_beta, round(ndcg, 6) AS val_ndcg,
       round((SELECT coalesce(sum(dcg / {_idcg('h')}), 0.0) FROM thits)
             / (SELECT count(DISTINCT user_id) FROM ttruth), 6) AS test_ndcg
FROM best"""
    per_user = stats + f""",
lst AS (SELECT item_id AS item, row_number() OVER (ORDER BY rating_sum / (rating_count + 250) DESC,
                                                     item_id) AS rank
        FROM stats QUALIFY rank <= 100),
truth AS (SELECT DISTINCT split, user_id, item_id AS item FROM sp WHERE split IN ('val', 'test')),
sizes AS (SELECT split, user_id, count(*) AS n_truth FROM truth GROUP BY 1, 2),
hits AS (SELECT t.split, t.user_id, count(*) AS hits, sum(1.0 / log2(l.rank + 1)) AS dcg
         FROM truth t JOIN lst l USING (item) GROUP BY 1, 2),
pu AS (SELECT s.user_id, s.split, coalesce(h.hits, 0)::BIGINT AS hits,
              coalesce(h.dcg / {_idcg('h.hits')}, 0.0) AS ndcg_hits,
              coalesce(h.dcg, 0.0) / {_idcg('least(s.n_truth, 100)')} AS ndcg_truth
       FROM sizes s LEFT JOIN hits h USING (split, user_id))"""
    q["ndcg_by_user"] = per_user + """
SELECT user_id, split, hits, round(ndcg_hits, 6) AS ndcg_hits, round(ndcg_truth, 6) AS ndcg_truth
FROM pu"""
    q["ndcg_mean"] = per_user + """
SELECT split, count(*)::BIGINT AS n_users, round(avg(ndcg_hits), 6) AS ndcg_hits,
       round(avg(ndcg_truth), 6) AS ndcg_truth
FROM pu GROUP BY split"""

    # personal lists: the favourite brand's most popular parts
    personal = stats + """,
brands AS (SELECT CAST(p_partkey AS BIGINT) AS item_id, p_brand AS grp FROM part
           WHERE p_partkey IS NOT NULL AND p_brand IS NOT NULL),
taste AS (SELECT user_id, grp, sum(rating) AS s, count(*) AS n FROM sp JOIN brands USING (item_id)
          WHERE split = 'train' GROUP BY 1, 2),
fav AS (SELECT user_id, grp FROM taste
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY s DESC, grp) = 1
        AND sum(n) OVER (PARTITION BY user_id) >= 30),
glists AS (SELECT grp, item_id AS item, row_number() OVER (
             PARTITION BY grp ORDER BY rating_sum / (rating_count + 250) DESC, item_id) AS rank
           FROM stats JOIN brands USING (item_id) QUALIFY rank <= 20),
recs AS (SELECT user_id, rank, item FROM fav JOIN glists USING (grp))"""
    q["personal_lists"] = personal + """
SELECT user_id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) AS items FROM recs GROUP BY user_id"""
    q["personal_ndcg"] = personal + f""",
ptruth AS (SELECT DISTINCT split, user_id, item_id AS item FROM sp WHERE split IN ('val', 'test') AND rating >= 4.0),
sizes AS (SELECT split, user_id, count(*) AS n FROM ptruth GROUP BY 1, 2),
phits AS (SELECT t.split, t.user_id, count(*) AS h, sum(1.0 / log2(r.rank + 1)) AS dcg
          FROM ptruth t JOIN recs r USING (user_id, item) GROUP BY 1, 2),
listed AS (SELECT DISTINCT user_id FROM recs),
met AS (SELECT s.split, s.user_id, s.n, coalesce(h.h, 0) AS h, coalesce(h.dcg, 0.0) AS dcg
        FROM sizes s JOIN listed USING (user_id) LEFT JOIN phits h USING (split, user_id))
SELECT split, count(*)::BIGINT AS n_users,
       ((SELECT count(*) FROM sizes z WHERE z.split = met.split) - count(*))::BIGINT AS n_truth_only,
       ((SELECT count(*) FROM listed) - count(*))::BIGINT AS n_lists_only,
       round(avg(CASE WHEN h = 0 THEN 0.0 ELSE dcg / {_idcg('h')} END), 6) AS ndcg_hits,
       round(avg(dcg / {_idcg('least(n, 20)')}), 6) AS ndcg_truth
FROM met GROUP BY split"""
    q["split_roundtrip"] = sp + """
SELECT user_id, item_id, rating, split FROM sp WHERE split = 'test' OR (split = 'val' AND rating >= 1.0)"""
    q["metric_results"] = sweep + f"""
SELECT beta::BIGINT AS beta, {TOP_K}::BIGINT AS k, round(ndcg, 6) AS val_ndcg FROM sw WHERE beta IN (250, 500)"""

    # backfill on documents
    dsp = "WITH " + DOC_TERMS + ",\n" + _split_cte("doc_terms", "item", "dsp") + """,
cold AS (SELECT DISTINCT h.split, h.item FROM dsp h WHERE h.split <> 'train'
         AND NOT EXISTS (SELECT 1 FROM dsp t WHERE t.split = 'train' AND t.item = h.item)),
bf AS (SELECT min(d.user_id) AS user_id, d.item, arg_min(d.rating, d.user_id) AS rating,
              0 AS tagged, d.split AS source
       FROM dsp d JOIN cold c ON c.split = d.split AND c.item = d.item
       GROUP BY d.split, d.item)"""
    q["cold_items"] = dsp + "\nSELECT split, item FROM cold"
    q["backfill_rows"] = dsp + "\nSELECT user_id, item, rating, tagged, source FROM bf"
    q["train_with_backfill"] = dsp + """
SELECT 'train' AS source, count(*)::BIGINT AS n_rows FROM dsp WHERE split = 'train'
UNION ALL SELECT source, count(*)::BIGINT FROM bf GROUP BY source"""

    # ALS inputs (the fit itself is rows-only)
    ai = tsp + """,
bfr AS (SELECT min(d.user_id) AS user_id, d.item_id, arg_min(d.rating, d.user_id) AS rating
        FROM tsp d WHERE d.split <> 'train'
        AND NOT EXISTS (SELECT 1 FROM tsp t WHERE t.split = 'train' AND t.item_id = d.item_id)
        GROUP BY d.split, d.item_id),
ai AS (SELECT CAST(user_id AS INTEGER) AS "user", CAST(item_id AS INTEGER) AS item,
              CAST(rating AS FLOAT) AS rating, CAST(tagged AS INTEGER) AS tagged
       FROM tsp WHERE split = 'train'
       UNION ALL
       SELECT CAST(user_id AS INTEGER), CAST(item_id AS INTEGER), CAST(rating AS FLOAT), 0 FROM bfr)"""
    q["als_input"] = ai + '\nSELECT "user", item, rating, tagged FROM ai'
    q["implicit_confidence"] = ai + """
SELECT "user", item, round(1.0 + 40.0 * CAST(rating AS DOUBLE) + 5.0 * tagged, 6) AS confidence
FROM ai"""
    q["implicit_confidence_avg"] = ai + """
SELECT round(avg(1.0 + 40.0 * CAST(rating AS DOUBLE) + 5.0 * tagged), 6) AS avg_confidence FROM ai"""
    return q
