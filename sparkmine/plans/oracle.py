"""DuckDB SQL oracles for the registered queries (same tables, same output
columns).  Itemsets come from brute-force subset enumeration (a recursive
CTE over each basket), so they check the Spark miners independently."""

from __future__ import annotations

from sparkmine.plans.catalog import BRAND_SUPPORT, SEED, SON_BUCKETS, TYPE_SUPPORT
from sparkmine.plans.queries import (
    DIFF_SUPPORT,
    FRACTION,
    HIST_BINS,
    HIST_HI,
    HIST_LO,
    KMEANSPP_K,
    MINIBATCH_B,
    MODIFIED,
    MODIFIED_BUCKETS,
    MODIFIED_SUPPORT,
    NOISE_HI,
    NOISE_LO,
    NOISE_SIGMA,
    PAD_TARGET,
    PRUNE_SUPPORT,
    RESTRICT_ITEMS,
    RULE_CONFIDENCE,
    SAMPLE_B,
    SMOOTH_SIGMA,
    SWEEP,
)
from sparkmine.operators.series import gaussian_kernel

TWO52 = "4503599627370496.0::DOUBLE"


def _h(*parts: str) -> str:
    """Seeded 52-bit hash, same as functions.columns.seeded_hash."""
    return f"CAST(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13)) AS BIGINT)"


def _u(*parts: str) -> str:
    return f"({_h(*parts)} / {TWO52})"


def _baskets(attr: str) -> str:
    return (
        f"SELECT l_orderkey AS txn_id, list_sort(list(DISTINCT {attr})) AS items "
        f"FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"
    )


def _min_count(support: float) -> str:
    return f"SELECT CAST(ceil(CAST({support!r} AS DOUBLE) * count(*)) AS BIGINT) AS min_count, count(*) AS n FROM b"


_SUBSETS = """sub(txn_id, basket, iset, pos) AS (
  SELECT txn_id, items, [items[i]], i FROM (SELECT txn_id, items, unnest(range(1, len(items) + 1)) AS i FROM b)
  UNION ALL
  SELECT txn_id, basket, list_append(iset, basket[j]), j
  FROM (SELECT txn_id, basket, iset, unnest(range(pos + 1, len(basket) + 1)) AS j FROM sub)
)"""


def _frequent(attr: str, support: float) -> str:
    """CTEs b, th, sub, f(k, items, support_count) of all frequent itemsets."""
    return f"""WITH RECURSIVE b AS ({_baskets(attr)}),
th AS ({_min_count(support)}),
{_SUBSETS},
f AS (SELECT CAST(len(iset) AS INTEGER) AS k, iset AS items, count(*) AS support_count
      FROM sub GROUP BY iset HAVING count(*) >= (SELECT min_count FROM th))"""


def _itemsets_out(attr: str, support: float) -> str:
    return _frequent(attr, support) + "\nSELECT k, array_to_string(items, ',') AS items, support_count FROM f"


def _growth(f_cte: str, group: str | None, k1_sql: str) -> str:
    """Candidates per level (J1 + J2) from a frequent table f(g?, k, items).

    ``k1_sql`` gives the k = 1 rows (g?, n)."""
    gsel = f"{group}, " if group else ""
    gjoin = f"a.{group} = b2.{group} AND " if group else ""
    gon = f"f2.{group} = cs.{group} AND " if group else ""
    gby = f"{group}, " if group else ""
    return f"""{f_cte},
lvl AS (SELECT {gby}k, count(*) AS n FROM f GROUP BY ALL),
cand AS (SELECT {('a.' + group + ', ') if group else ''}a.k + 1 AS k, list_append(a.items, b2.items[-1]) AS items
         FROM f a JOIN f b2 ON {gjoin}a.k = b2.k AND a.k >= 2
          AND a.items[1:a.k - 1] = b2.items[1:b2.k - 1] AND a.items[-1] < b2.items[-1]),
cs AS (SELECT {gby}k, items, list_concat(items[1:i - 1], items[i + 1:]) AS sub
       FROM (SELECT {gby}k, items, unnest(range(1, k + 1)) AS i FROM cand)),
bad AS (SELECT DISTINCT {('cs.' + group + ', ') if group else ''}cs.k, cs.items FROM cs
        LEFT JOIN f f2 ON {gon}f2.k = cs.k - 1 AND f2.items = cs.sub WHERE f2.items IS NULL),
good AS (SELECT {gby}k, count(*) AS n FROM (SELECT {gby}k, items FROM cand EXCEPT SELECT {gby}k, items FROM bad) GROUP BY ALL),
steps AS (
  SELECT {gby}1 AS k, n FROM ({k1_sql})
  UNION ALL
  SELECT {gby}2 AS k, n * (n - 1) // 2 AS n FROM lvl WHERE k = 1
  UNION ALL
  SELECT {('l.' + group + ', ') if group else ''}l.k + 1 AS k, coalesce(g.n, 0) AS n
  FROM lvl l LEFT JOIN good g ON {('l.' + group + ' = g.' + group + ' AND ') if group else ''}g.k = l.k + 1 WHERE l.k >= 2
)
SELECT {('CAST(' + group + ' AS INTEGER) AS ' + group + ', ') if group else ''}CAST(k AS INTEGER) AS k, CAST(n AS BIGINT) AS n_candidates FROM steps"""


def _son_local_cte(attr: str, support: float, p: int) -> str:
    return f"""WITH RECURSIVE b AS ({_baskets(attr)}),
th AS ({_min_count(support)}),
lm AS (SELECT CAST(ceil(CAST(min_count AS DOUBLE) / {p}) AS BIGINT) AS local_min FROM th),
{_SUBSETS},
f AS (SELECT txn_id % {p} AS bucket, CAST(len(iset) AS INTEGER) AS k, iset AS items, count(*) AS support_count
      FROM sub GROUP BY ALL HAVING count(*) >= (SELECT local_min FROM lm))"""


def _modified(restrict: int | None, pad: int | None, seed) -> str:
    """CTEs ending in bag(txn_id, items), the modified brand baskets, and b, the same as sets."""
    draw = lambda tag: f"p[CAST(floor({_u(f"'{seed}'", f"'{tag}'", 'txn_id', 'sl')} * len(p)) AS BIGINT) + 1]"
    if restrict is not None:
        bag = f"""ic AS (SELECT item, count(*) AS n FROM (SELECT unnest(items) AS item FROM b0) GROUP BY item),
pool AS (SELECT list(item ORDER BY n DESC, item ASC) AS p FROM (SELECT * FROM ic ORDER BY n DESC, item ASC LIMIT {restrict})),
kk AS (SELECT txn_id, items, p, list_filter(items, lambda x: list_contains(p, x)) AS kept FROM b0, pool),
bag AS (SELECT txn_id, list_concat(kept, list_transform(range(1, len(items) - len(kept) + 1), lambda sl: {draw('restrict')})) AS items FROM kk)"""
    elif pad is not None:
        bag = f"""pool AS (SELECT list(item ORDER BY item) AS p FROM (SELECT DISTINCT unnest(items) AS item FROM b0)),
bag AS (SELECT txn_id, list_distinct(list_concat(items, list_transform(range(1, greatest({pad} - len(items), 0) + 1), lambda sl: {draw('pad')}))) AS items FROM b0, pool)"""
    else:
        bag = "bag AS (SELECT * FROM b0)"
    return f"b0 AS ({_baskets('p_brand')}),\n{bag},\nb AS (SELECT txn_id, list_sort(list_distinct(items)) AS items FROM bag)"


def _modified_local(restrict: int | None, pad: int | None, seed) -> str:
    """The locally frequent sets f(bucket, k, items) of the modified baskets."""
    return f"""WITH RECURSIVE {_modified(restrict, pad, seed)},
th AS ({_min_count(MODIFIED_SUPPORT)}),
lm AS (SELECT CAST(ceil(CAST(min_count AS DOUBLE) / {MODIFIED_BUCKETS}) AS BIGINT) AS local_min FROM th),
{_SUBSETS},
f AS (SELECT txn_id % {MODIFIED_BUCKETS} AS bucket, CAST(len(iset) AS INTEGER) AS k, iset AS items, count(*) AS support_count
      FROM sub GROUP BY ALL HAVING count(*) >= (SELECT local_min FROM lm))"""


def _points() -> str:
    return "pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _label_means() -> str:
    return """cm AS (SELECT label AS cluster, list(m ORDER BY pos) AS center FROM (
        SELECT label, pos, avg(v) AS m FROM (
          SELECT label, unnest(range(0, len(e))) AS pos, unnest(e) AS v FROM pts) GROUP BY label, pos)
      GROUP BY label)"""


def _nearest(points_cte: str, centers_cte: str, name: str) -> str:
    """CTE ``name``(vec_id, label, e, cluster, dist): nearest centre, ties to the lowest id."""
    return f"""{name} AS (SELECT vec_id, label, e, cluster, dist FROM (
        SELECT p.vec_id, p.label, p.e, c.cluster, list_distance(p.e, c.center) AS dist,
               row_number() OVER (PARTITION BY p.vec_id ORDER BY list_distance(p.e, c.center), c.cluster) AS rn
        FROM {points_cte} p CROSS JOIN {centers_cte} c) WHERE rn = 1)"""


def _update(assigned: str, centers: str, name: str) -> str:
    """CTE ``name``(cluster, center, n): running-mean update of ``centers``."""
    return f"""{name}_c AS (SELECT cluster, n, unnest(range(0, len(center))) AS pos, unnest(center) AS cv FROM {centers}),
{name}_s AS (SELECT cluster, pos, sum(v) AS s FROM (
        SELECT cluster, unnest(range(0, len(e))) AS pos, unnest(e) AS v FROM {assigned}) GROUP BY cluster, pos),
{name}_m AS (SELECT cluster, count(*) AS m FROM {assigned} GROUP BY cluster),
{name} AS (
  SELECT c.cluster,
         list(CASE WHEN mm.m IS NULL THEN c.cv
              ELSE (CAST(c.n AS DOUBLE) * c.cv + z.s) / (CAST(c.n AS DOUBLE) + CAST(mm.m AS DOUBLE)) END ORDER BY c.pos) AS center,
         any_value(c.n) + coalesce(any_value(mm.m), 0) AS n
  FROM {name}_c c LEFT JOIN {name}_m mm ON mm.cluster = c.cluster
  LEFT JOIN {name}_s z ON z.cluster = c.cluster AND z.pos = c.pos
  GROUP BY c.cluster)"""


def _hist_cte() -> str:
    bins, lo, hi = HIST_BINS, HIST_LO, HIST_HI
    step = (hi - lo) / bins

    def edge(i: str) -> str:
        return f"(CASE WHEN ({i}) >= {bins} THEN {hi!r}::DOUBLE ELSE CAST({i} AS DOUBLE) * {step!r}::DOUBLE + {lo!r}::DOUBLE END)"

    return f"""inr AS (SELECT CAST(value AS DOUBLE) AS v FROM events
        WHERE value IS NOT NULL AND value >= {lo!r} AND value <= {hi!r}),
i0 AS (SELECT v, CAST(floor((v - {lo!r}::DOUBLE) / {float(hi - lo)!r}::DOUBLE * {float(bins)!r}::DOUBLE) AS INTEGER) AS i FROM inr),
i1 AS (SELECT v, CASE WHEN i = {bins} THEN {bins - 1} ELSE i END AS i FROM i0),
i2 AS (SELECT v, CASE WHEN v < {edge('i')} THEN i - 1 ELSE i END AS i FROM i1),
i3 AS (SELECT v, CASE WHEN v >= {edge('i + 1')} AND i <> {bins - 1} THEN i + 1 ELSE i END AS i FROM i2),
cnt AS (SELECT i AS bin, count(*) AS n FROM i3 GROUP BY i),
tot AS (SELECT count(*) AS t FROM inr),
hist AS (SELECT CAST(r.bin AS INTEGER) AS bin,
        ({edge('r.bin')} + {edge('r.bin + 1')}) / 2.0::DOUBLE AS center,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n,
        CASE WHEN (SELECT t FROM tot) > 0 THEN CAST(coalesce(c.n, 0) AS DOUBLE) / ({edge('r.bin + 1')} - {edge('r.bin')}) / (SELECT t FROM tot) END AS density
      FROM (SELECT range AS bin FROM range(0, {bins})) r LEFT JOIN cnt c ON c.bin = r.bin)"""


def oracle_sql() -> dict[str, str]:
    s = SEED
    q: dict[str, str] = {}
    q["baskets"] = f"SELECT txn_id, array_to_string(items, ',') AS items FROM ({_baskets('p_type')})"
    q["item_support"] = f"""WITH b AS ({_baskets('p_brand')}), th AS ({_min_count(BRAND_SUPPORT)})
SELECT item, count(*) AS support_count FROM (SELECT unnest(items) AS item FROM b)
GROUP BY item HAVING count(*) >= (SELECT min_count FROM th)"""
    q["transaction_profile"] = f"""WITH b AS ({_baskets('p_type')}),
d AS (SELECT count(DISTINCT item) AS di FROM (SELECT unnest(items) AS item FROM b)),
p AS (SELECT count(*) AS n, coalesce(avg(len(items)), 0.0) AS avg_len FROM b)
SELECT CAST(n AS BIGINT) AS n, round(avg_len, 6) AS avg_len, CAST(di AS BIGINT) AS distinct_items,
       round(CASE WHEN di > 0 THEN avg_len / di ELSE 0.0 END, 6) AS density FROM p, d"""
    q["apriori_type"] = _itemsets_out("p_type", TYPE_SUPPORT)
    q["apriori_brand"] = _itemsets_out("p_brand", BRAND_SUPPORT)
    q["son_type"] = q["apriori_type"]
    q["son_brand"] = q["apriori_brand"]
    q["fp_growth"] = q["apriori_brand"]
    q["candidate_growth"] = _growth(_frequent("p_brand", BRAND_SUPPORT), None, "SELECT n FROM lvl WHERE k = 1")
    q["prune_candidates"] = _frequent("p_brand", BRAND_SUPPORT) + """,
f2 AS (SELECT items FROM f WHERE k = 2),
cand AS (SELECT list_append(a.items, b2.items[-1]) AS items FROM f2 a JOIN f2 b2
         ON a.items[1:1] = b2.items[1:1] AND a.items[-1] < b2.items[-1]),
cs AS (SELECT items, list_concat(items[1:i - 1], items[i + 1:]) AS sub
       FROM (SELECT items, unnest(range(1, 4)) AS i FROM cand)),
bad AS (SELECT DISTINCT cs.items FROM cs LEFT JOIN f2 ON f2.items = cs.sub WHERE f2.items IS NULL)
SELECT array_to_string(items, ',') AS items FROM (SELECT items FROM cand EXCEPT SELECT items FROM bad)"""
    q["son_local"] = _son_local_cte("p_brand", BRAND_SUPPORT, SON_BUCKETS) + """
SELECT CAST(bucket AS INTEGER) AS bucket, k, array_to_string(items, ',') AS items, support_count FROM f"""
    q["son_candidate_stats"] = _growth(
        _son_local_cte("p_brand", BRAND_SUPPORT, SON_BUCKETS),
        "bucket",
        f"SELECT txn_id % {SON_BUCKETS} AS bucket, count(DISTINCT item) AS n FROM (SELECT txn_id, unnest(items) AS item FROM b) GROUP BY ALL",
    )
    q["count_candidates"] = _son_local_cte("p_brand", BRAND_SUPPORT, SON_BUCKETS) + """,
cands AS (SELECT DISTINCT items FROM f),
allc AS (SELECT iset AS items, count(*) AS c FROM sub GROUP BY iset)
SELECT array_to_string(c.items, ',') AS items, CAST(coalesce(a.c, 0) AS BIGINT) AS support_count
FROM cands c LEFT JOIN allc a ON a.items = c.items"""
    q["prune_infrequent"] = f"""WITH b AS ({_baskets('p_brand')}), th AS ({_min_count(PRUNE_SUPPORT)}),
l1 AS (SELECT item FROM (SELECT unnest(items) AS item FROM b) GROUP BY item HAVING count(*) >= (SELECT min_count FROM th))
SELECT txn_id, array_to_string(list_sort(list(item)), ',') AS items
FROM (SELECT txn_id, unnest(items) AS item FROM b) JOIN l1 USING (item) GROUP BY txn_id"""
    q["association_rules"] = _frequent("p_type", TYPE_SUPPORT) + f""",
r AS (SELECT items AS full_items, support_count AS c_full, unnest(items) AS y FROM f WHERE k >= 2),
r2 AS (SELECT list_filter(full_items, lambda x: x <> y) AS antecedent, [y] AS consequent, c_full FROM r)
SELECT array_to_string(r2.antecedent, ',') AS antecedent, array_to_string(r2.consequent, ',') AS consequent,
       CAST(r2.c_full AS BIGINT) AS support_count,
       round(r2.c_full / fa.support_count, 6) AS confidence,
       round((r2.c_full / fa.support_count) / (fc.support_count / CAST((SELECT n FROM th) AS DOUBLE)), 6) AS lift,
       round(r2.c_full / CAST((SELECT n FROM th) AS DOUBLE), 6) AS support
FROM r2 JOIN f fa ON fa.items = r2.antecedent JOIN f fc ON fc.items = r2.consequent
WHERE r2.c_full / fa.support_count >= {RULE_CONFIDENCE!r}"""
    q["itemset_diff"] = f"""WITH RECURSIVE b AS ({_baskets('p_type')}),
th AS ({_min_count(TYPE_SUPPORT)}), th2 AS ({_min_count(DIFF_SUPPORT)}),
{_SUBSETS},
c AS (SELECT iset AS items, count(*) AS support_count FROM sub GROUP BY iset),
fa AS (SELECT * FROM c WHERE support_count >= (SELECT min_count FROM th)),
fb AS (SELECT * FROM c WHERE support_count >= (SELECT min_count FROM th2))
SELECT array_to_string(coalesce(fa.items, fb.items), ',') AS items,
       CASE WHEN fa.items IS NULL THEN 'right_only' WHEN fb.items IS NULL THEN 'left_only' ELSE 'both' END AS side,
       fa.support_count AS count_a, fb.support_count AS count_b
FROM fa FULL OUTER JOIN fb ON fa.items = fb.items"""
    blocks = []
    for run_id, (sup, p, frac) in enumerate(SWEEP):
        src, cnt = ("bh", "cnt_half") if frac is not None else ("b", "cnt_all")
        mc = f"CAST(ceil(CAST({sup!r} AS DOUBLE) * (SELECT count(*) FROM {src})) AS BIGINT)"
        blocks.append(
            f"""SELECT {run_id} AS run_id, 'brand' AS dataset, (SELECT count(*) FROM {src}) AS n,
  (SELECT avg(len(items)) FROM {src}) AS avg_len,
  (SELECT count(DISTINCT item) FROM (SELECT unnest(items) AS item FROM {src})) AS distinct_items,
  {sup!r}::DOUBLE AS support, {p} AS num_partitions,
  CAST(ceil(CAST({mc} AS DOUBLE) / {p}) AS BIGINT) AS local_min,
  (SELECT count(*) FROM {cnt} WHERE c >= {mc}) AS n_itemsets"""
        )
    half = [f for _, _, f in SWEEP if f is not None][0]
    q["son_sweep"] = f"""WITH RECURSIVE b AS ({_baskets('p_brand')}),
bh AS (SELECT txn_id, items FROM (SELECT txn_id, items, row_number() OVER (ORDER BY txn_id) - 1 AS idx FROM b)
       WHERE idx < (SELECT CAST(floor(count(*) * CAST({half!r} AS DOUBLE)) AS BIGINT) FROM b)),
{_SUBSETS},
cnt_all AS (SELECT iset, count(*) AS c FROM sub GROUP BY iset),
cnt_half AS (SELECT iset, count(*) AS c FROM sub WHERE txn_id IN (SELECT txn_id FROM bh) GROUP BY iset),
runs AS ({' UNION ALL '.join(blocks)})
SELECT CAST(run_id AS INTEGER) AS run_id, dataset, CAST(n AS BIGINT) AS n, round(avg_len, 6) AS avg_len,
  CAST(distinct_items AS BIGINT) AS distinct_items, round(avg_len / distinct_items, 6) AS density, support,
  CAST(num_partitions AS INTEGER) AS num_partitions, local_min, CAST(n_itemsets AS BIGINT) AS n_itemsets FROM runs"""
    k1 = f"SELECT txn_id % {MODIFIED_BUCKETS} AS bucket, count(DISTINCT item) AS n FROM (SELECT txn_id, unnest(items) AS item FROM b) GROUP BY ALL"
    cands = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS run_id, k, CAST(sum(n_candidates) AS BIGINT) AS n_candidates FROM ({_growth(_modified_local(m, t, SEED), 'bucket', k1)}) GROUP BY k"
        for i, (m, t) in enumerate(MODIFIED)
    )
    runs = "\nUNION ALL\n".join(
        f"""SELECT * FROM ({_modified_local(m, t, SEED)}
SELECT CAST({i} AS INTEGER) AS run_id, (SELECT count(*) FROM bag) AS n, (SELECT round(avg(len(items)), 6) FROM bag) AS avg_len,
  (SELECT count(DISTINCT item) FROM (SELECT unnest(items) AS item FROM bag)) AS distinct_items, (SELECT local_min FROM lm) AS local_min,
  (SELECT count(*) FROM (SELECT iset FROM sub GROUP BY iset HAVING count(*) >= (SELECT min_count FROM th))) AS n_itemsets)"""
        for i, (m, t) in enumerate(MODIFIED)
    )
    q["sweep_modified"] = f"SELECT * FROM ({runs}) JOIN ({cands}) USING (run_id)"
    hashed = f"CAST(floor({_u(f"'{SEED}'", 'txn_id')} * {SON_BUCKETS}) AS BIGINT) AS bucket"
    q["son_hash"] = _son_local_cte("p_brand", BRAND_SUPPORT, SON_BUCKETS).replace(f"txn_id % {SON_BUCKETS} AS bucket", hashed) + """
SELECT CAST(bucket AS INTEGER) AS bucket, k, array_to_string(items, ',') AS items, support_count FROM f"""
    q["count_open_family"] = f"""WITH RECURSIVE b AS ({_baskets('p_brand')}),
{_SUBSETS},
allc AS (SELECT iset AS items, count(*) AS c FROM sub GROUP BY iset)
SELECT array_to_string(items, ',') AS items, CAST(c AS BIGINT) AS support_count
FROM allc WHERE items IN (SELECT items FROM b WHERE len(items) BETWEEN 2 AND 4)"""
    # ---- modifiers
    q["restrict_items"] = f"""WITH b AS ({_baskets('p_type')}),
ic AS (SELECT item, count(*) AS n FROM (SELECT unnest(items) AS item FROM b) GROUP BY item),
pool AS (SELECT list(item ORDER BY n DESC, item ASC) AS p FROM (SELECT * FROM ic ORDER BY n DESC, item ASC LIMIT {RESTRICT_ITEMS})),
k AS (SELECT txn_id, items, p, list_filter(items, lambda x: list_contains(p, x)) AS kept FROM b, pool)
SELECT txn_id, array_to_string(list_concat(kept, list_transform(range(1, len(items) - len(kept) + 1),
    lambda sl: p[CAST(floor({_u(f"'{s}'", "'restrict'", 'txn_id', 'sl')} * len(p)) AS BIGINT) + 1])), ',') AS items
FROM k"""
    q["pad_transactions"] = f"""WITH b AS ({_baskets('p_type')}),
pool AS (SELECT list(item ORDER BY item) AS p FROM (SELECT DISTINCT unnest(items) AS item FROM b))
SELECT txn_id, array_to_string(list_sort(list_distinct(list_concat(items, list_transform(range(1, greatest({PAD_TARGET} - len(items), 0) + 1),
    lambda sl: p[CAST(floor({_u(f"'{s}'", "'pad'", 'txn_id', 'sl')} * len(p)) AS BIGINT) + 1])))), ',') AS items
FROM b, pool"""
    q["take_fraction"] = f"""WITH b AS ({_baskets('p_brand')}), n AS (SELECT count(*) AS n FROM b)
SELECT txn_id, array_to_string(items, ',') AS items FROM (
  SELECT txn_id, items, row_number() OVER (ORDER BY txn_id) - 1 AS idx FROM b)
WHERE idx < (SELECT CAST(floor(n * CAST({FRACTION!r} AS DOUBLE)) AS BIGINT) FROM n)"""
    q["dense_index"] = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders"
    q["expand_by_weight"] = """SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, unnest(range(CAST(trunc(l_quantity) AS BIGINT))) AS r FROM lineitem WHERE l_quantity >= 1)"""
    q["explode_matrix"] = """SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(CAST(value AS DOUBLE), 6) AS value FROM (
  SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS value FROM embeddings)"""
    q["augment_points"] = f"""WITH {_points()},
nn AS (SELECT count(*) AS n, max(vec_id) AS mx FROM pts),
ix AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM pts),
cp AS (SELECT range AS j, CAST(floor({_u(f"'{s}'", "'source'", 'range')} * (SELECT n FROM nn)) AS BIGINT) AS idx
       FROM range(0, (SELECT n FROM nn))),
nw AS (SELECT (SELECT mx FROM nn) + 1 + cp.j AS vec_id, ix.vec_id AS source_id, ix.label, cp.j, ix.e FROM cp JOIN ix USING (idx)),
nv AS (SELECT vec_id, source_id, label, pos, greatest({NOISE_LO!r}::DOUBLE, least({NOISE_HI!r}::DOUBLE, x + {NOISE_SIGMA!r}::DOUBLE *
         (sqrt(-2.0::DOUBLE * ln(({_h(f"'{s}'", "'noise_r'", 'j', 'pos')} + 0.5::DOUBLE) / {TWO52}))
          * cos(6.283185307179586::DOUBLE * {_u(f"'{s}'", "'noise_t'", 'j', 'pos')})))) AS value
       FROM (SELECT vec_id, source_id, label, j, unnest(range(0, len(e))) AS pos, unnest(e) AS x FROM nw))
SELECT vec_id, CAST(NULL AS BIGINT) AS source_id, label, CAST(pos AS INTEGER) AS pos, round(value, 4) AS value FROM (
  SELECT vec_id, label, unnest(range(0, len(e))) AS pos, unnest(e) AS value FROM pts)
UNION ALL
SELECT vec_id, source_id, label, CAST(pos AS INTEGER) AS pos, round(value, 4) AS value FROM nv"""
    # ---- clustering
    q["assign_nearest"] = f"""WITH {_points()}, {_label_means()}, {_nearest('pts', 'cm', 'a')}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(dist, 6) AS dist FROM a"""
    q["sse"] = f"""WITH {_points()}, {_label_means()}, {_nearest('pts', 'cm', 'a')}
SELECT round(sum(dist * dist), 6) AS sse FROM a"""
    q["update_centers"] = f"""WITH {_points()}, {_label_means()},
c0 AS (SELECT cluster, center, 0 AS n FROM cm),
{_nearest('pts', 'c0', 'a')},
{_update('a', 'c0', 'c1')}
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(n AS BIGINT) AS n, CAST(pos AS INTEGER) AS pos, round(value, 6) AS value FROM (
  SELECT cluster, n, unnest(range(0, len(center))) AS pos, unnest(center) AS value FROM c1)"""
    q["sample_exact"] = f"""SELECT vec_id, label FROM embeddings
ORDER BY {_h(f"'{s}'", "'sample'", "'0'", 'vec_id')}, vec_id LIMIT {SAMPLE_B}"""
    steps = [f"""p0 AS (SELECT vec_id, e FROM pts ORDER BY {_h(f"'{s}'", "'kmeanspp'", "'0'", 'vec_id')}, vec_id LIMIT 1)"""]
    prev_d = None
    for st in range(1, KMEANSPP_K):
        d_new = f"list_distance(pts.e, (SELECT e FROM p{st - 1}))"
        d_expr = d_new if prev_d is None else f"least(d{st - 1}.d, {d_new})"
        src = "pts" if prev_d is None else f"pts JOIN d{st - 1} USING (vec_id)"
        steps.append(f"d{st} AS (SELECT pts.vec_id, pts.e, {d_expr} AS d FROM {src})")
        key = f"CASE WHEN d > 0 THEN -ln(({_h(f"'{s}'", "'kmeanspp'", f"'{st}'", 'vec_id')} + 0.5::DOUBLE) / {TWO52}) / d END"
        steps.append(f"p{st} AS (SELECT vec_id, e FROM d{st} ORDER BY {key} NULLS LAST, vec_id LIMIT 1)")
        prev_d = st
    picks = " UNION ALL ".join(f"SELECT {i} AS step, vec_id FROM p{i}" for i in range(KMEANSPP_K))
    q["kmeanspp_pick"] = f"WITH {_points()},\n" + ",\n".join(steps) + f"\nSELECT CAST(step AS INTEGER) AS step, vec_id FROM ({picks})"
    batches = []
    for it in range(2):
        batches.append(
            f"""bt{it} AS (SELECT * FROM pts ORDER BY {_h(f"'{s}'", "'sample'", f"'{it}'", 'vec_id')}, vec_id LIMIT {MINIBATCH_B})"""
        )
    q["minibatch_2"] = f"""WITH {_points()}, {_label_means()},
c0 AS (SELECT cluster, center, 0 AS n FROM cm),
{batches[0]}, {_nearest('bt0', 'c0', 'a0')}, {_update('a0', 'c0', 'c1')},
{batches[1]}, {_nearest('bt1', 'c1', 'a1')}, {_update('a1', 'c1', 'c2')},
{_nearest('pts', 'c2', 'fin')}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM fin"""
    # ---- evaluation
    q["contingency"] = """SELECT o_orderpriority, o_orderstatus, count(*) AS n,
  CAST(GROUPING(o_orderpriority, o_orderstatus) AS INTEGER) AS gid
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)"""
    q["entropy"] = """WITH c AS (SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY ALL),
t AS (SELECT count(*) AS t FROM orders)
SELECT round(coalesce(-sum((c / t) * log2(c / t)), 0.0), 6) AS entropy FROM c, t"""
    q["nmi"] = f"""WITH {_points()}, {_label_means()}, {_nearest('pts', 'cm', 'a')},
t AS (SELECT count(*) AS t FROM a),
j AS (SELECT label, cluster, count(*) AS c FROM a GROUP BY ALL),
l AS (SELECT label, count(*) AS c FROM a GROUP BY ALL),
k AS (SELECT cluster, count(*) AS c FROM a GROUP BY ALL),
hl AS (SELECT -sum((c / (SELECT t FROM t)) * log2(c / (SELECT t FROM t))) AS h FROM l),
hc AS (SELECT -sum((c / (SELECT t FROM t)) * log2(c / (SELECT t FROM t))) AS h FROM k),
mi AS (SELECT sum((j.c / (SELECT t FROM t)) * log2((j.c / (SELECT t FROM t)) / ((l.c / (SELECT t FROM t)) * (k.c / (SELECT t FROM t))))) AS mi
       FROM j JOIN l USING (label) JOIN k USING (cluster))
SELECT round(mi, 6) AS mi, round((SELECT h FROM hl), 6) AS h_label, round((SELECT h FROM hc), 6) AS h_cluster,
       round(CASE WHEN ((SELECT h FROM hc) + (SELECT h FROM hl)) / 2.0 > 0 THEN mi / (((SELECT h FROM hc) + (SELECT h FROM hl)) / 2.0) END, 6) AS nmi
FROM mi"""
    q["frequency_table"] = """SELECT event_type AS value, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY event_type"""
    # ---- series
    q["histogram_density"] = f"""WITH {_hist_cte()}
SELECT bin, round(center, 6) AS center, n, round(density, 6) AS density FROM hist"""
    w = gaussian_kernel(SMOOTH_SIGMA)
    r = (len(w) - 1) // 2
    sig2 = SMOOTH_SIGMA * SMOOTH_SIGMA
    q["gaussian_smooth"] = f"""WITH {_hist_cte()},
kr AS (SELECT range AS j, exp(-0.5::DOUBLE * range * range / {sig2!r}::DOUBLE) AS raw FROM range(-{r}, {r + 1})),
kw AS (SELECT j, raw / (SELECT sum(raw) FROM kr) AS w FROM kr),
nb AS (SELECT count(*) AS n FROM hist),
pr AS (SELECT h.bin AS i, kw.j, kw.w, ((h.bin + kw.j) % (2 * (SELECT n FROM nb)) + 2 * (SELECT n FROM nb)) % (2 * (SELECT n FROM nb)) AS m
       FROM hist h CROSS JOIN kw),
src AS (SELECT i, w, CASE WHEN m < (SELECT n FROM nb) THEN m ELSE 2 * (SELECT n FROM nb) - 1 - m END AS s FROM pr)
SELECT CAST(i AS INTEGER) AS bin, round(sum(w * h.density), 6) AS density FROM src JOIN hist h ON h.bin = src.s GROUP BY i"""
    q["ordinal_gap"] = """WITH r AS (SELECT user_id, value,
    row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) - 1 AS rk,
    count(*) OVER (PARTITION BY user_id) AS c FROM events),
g AS (SELECT user_id, max(c // 2) AS n,
    max(value) FILTER (WHERE rk = c // 2) AS hi, max(value) FILTER (WHERE rk = c // 2 - 1) AS lo FROM r GROUP BY user_id)
SELECT user_id, CAST(n AS BIGINT) AS n, round(hi - lo, 6) AS gap FROM g WHERE hi IS NOT NULL AND lo IS NOT NULL"""
    return q
