"""Independent SQL (DuckDB dialect) for the registered queries.

These are deliberately written the straightforward relational way (self-joins,
windows, ``quantile_cont``) so they check the Spark operators rather than
mirror them. Tables: the star-schema test tables as views.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Shared CTEs
# ---------------------------------------------------------------------------

STAR = """lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN part p ON l.l_partkey = p.p_partkey"""


def tx_raw(variant: str = "clean") -> str:
    product = "'P' || lpad(CAST(l.l_partkey AS VARCHAR), 8, '0')"
    stay = "CASE WHEN l.l_linenumber >= 4 THEN '4+' ELSE CAST(l.l_linenumber AS VARCHAR) END"
    category = "CASE WHEN p.p_size = 50 THEN NULL ELSE split_part(p.p_brand, '#', 2) END"
    purchase = "l.l_extendedprice"
    age, user = "o.o_orderpriority", "o.o_custkey"
    if variant == "dirty":
        purchase = f"CASE WHEN l.l_quantity = 50 THEN NULL ELSE {purchase} END"
        stay = f"CASE WHEN l.l_discount = CAST(0.1 AS DOUBLE) THEN NULL ELSE {stay} END"
        age = f"CASE WHEN l.l_linenumber = 7 THEN NULL ELSE {age} END"
        product = f"CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE {product} END"
        category = f"CASE WHEN p.p_size = 49 THEN 'abc' ELSE {category} END"
        stay = f"CASE WHEN l.l_linenumber = 2 AND l.l_quantity < 10 THEN '2.0' ELSE {stay} END"
        user = "CASE WHEN o.o_orderkey % 101 = 0 THEN NULL ELSE o.o_custkey END"
    if variant == "planted":
        category = f"CASE WHEN o.o_custkey % 50 = 0 THEN '26' ELSE {category} END"
        purchase = f"CASE WHEN o.o_custkey % 50 = 0 THEN CAST(5 AS DOUBLE) * {purchase} / CAST(100 AS DOUBLE) ELSE {purchase} END"
    body = f"""SELECT CAST({user} AS INTEGER) AS User_ID,
      {product} AS Product_ID,
      l.l_linestatus AS Gender,
      {age} AS Age,
      CAST(c.c_nationkey AS SMALLINT) AS Occupation,
      l.l_returnflag AS City_Category,
      {stay} AS Stay,
      CAST(CASE WHEN l.l_tax >= CAST(0.04 AS DOUBLE) THEN 1 ELSE 0 END AS TINYINT) AS Marital_Status,
      {category} AS Product_Category,
      CAST({purchase} AS FLOAT) AS Purchase
    FROM {STAR}"""
    if variant == "dup":
        body = f"{body}\n    UNION ALL\n    {body}"
    return body


def clean_ctes(variant: str = "clean", q_low: float = 0.01, q_high: float = 0.99) -> str:
    """CTEs ``raw``, ``dd``, ``b``, ``m``, ``q``, ``tx`` (the cleaned table)."""
    winsor = 0 < q_low < q_high < 1
    q = (f"SELECT quantile_cont(Purchase0, CAST({q_low} AS DOUBLE)) AS lo, "
         f"quantile_cont(Purchase0, CAST({q_high} AS DOUBLE)) AS hi FROM b") if winsor else \
        "SELECT CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi"
    mode = lambda c: (f"(SELECT {c} FROM b WHERE {c} IS NOT NULL GROUP BY {c} "  # noqa: E731
                      f"ORDER BY count(*) DESC, {c} LIMIT 1)")
    purchase = "LEAST(GREATEST(Purchase0, q.lo), q.hi)" if winsor else "Purchase0"
    return f"""raw AS ({tx_raw(variant)}),
dd AS (SELECT DISTINCT User_ID, Product_ID, Gender, Age, Occupation, City_Category, Stay, Marital_Status,
         TRY_CAST(Product_Category AS FLOAT) AS pc, Purchase FROM raw WHERE User_ID IS NOT NULL),
b AS (SELECT User_ID, Product_ID, COALESCE(Gender, 'Unknown') AS Gender, COALESCE(Age, 'Unknown') AS Age,
        Occupation, COALESCE(City_Category, 'Unknown') AS City_Category,
        CASE WHEN stay0 = floor(stay0) THEN TRY_CAST(stay0 AS TINYINT) END AS Stay, Marital_Status,
        CASE WHEN pc IS NULL OR isnan(pc) OR pc <> floor(pc) THEN NULL ELSE CAST(pc AS SMALLINT) END AS Product_Category,
        CASE WHEN Purchase IS NULL OR isnan(Purchase) THEN CAST(0 AS DOUBLE) ELSE CAST(Purchase AS DOUBLE) END AS Purchase0
      FROM (SELECT *, TRY_CAST(trim(replace(Stay, '+', '')) AS DOUBLE) AS stay0 FROM dd)),
m AS (SELECT COALESCE({mode('Occupation')}, 0) AS mode_occ, COALESCE({mode('Marital_Status')}, 0) AS mode_mar,
        COALESCE({mode("Stay")}, 0) AS mode_stay),
q AS ({q}),
tx AS (SELECT User_ID, Product_ID, Gender, Age,
         CAST(COALESCE(Occupation, m.mode_occ) AS SMALLINT) AS Occupation, City_Category,
         CAST(COALESCE(Stay, m.mode_stay) AS TINYINT) AS Stay_In_Current_City_Years,
         CAST(COALESCE(Marital_Status, m.mode_mar) AS TINYINT) AS Marital_Status,
         Product_Category, {purchase} AS Purchase,
         'cat_' || COALESCE(CAST(Product_Category AS VARCHAR), 'unknown') AS Product_Category_str
       FROM b CROSS JOIN m CROSS JOIN q)"""


def sql_clean(variant: str = "clean", q_low: float = 0.01, q_high: float = 0.99) -> str:
    return f"""WITH {clean_ctes(variant, q_low, q_high)}
SELECT User_ID, Product_ID, Gender, Age, Occupation, City_Category, Stay_In_Current_City_Years,
       Marital_Status, Product_Category, ROUND(Purchase, 4) AS Purchase, Product_Category_str FROM tx"""


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

def feature_ctes(top_cat: int = 10, variant: str = "clean") -> str:
    mode = lambda src, dst: f"""{dst} AS (SELECT User_ID, {src} AS v FROM (
    SELECT User_ID, {src}, ROW_NUMBER() OVER (PARTITION BY User_ID ORDER BY n DESC, {src}) AS rn
    FROM (SELECT User_ID, {src}, count(*) AS n FROM tx WHERE {src} IS NOT NULL GROUP BY User_ID, {src}))
  WHERE rn = 1)"""  # noqa: E731
    return f"""{clean_ctes(variant)},
basics AS (SELECT User_ID, CAST(count(*) AS BIGINT) AS n_transactions, sum(Purchase) AS total_purchase,
    avg(Purchase) AS avg_purchase, quantile_cont(Purchase, 0.5) AS median_purchase,
    COALESCE(stddev_samp(Purchase), 0) AS std_purchase, CAST(count(DISTINCT Product_ID) AS BIGINT) AS unique_products
  FROM tx GROUP BY User_ID),
{mode('Age', 'm_age')}, {mode('Gender', 'm_gender')}, {mode('City_Category', 'm_city')},
{mode('Stay_In_Current_City_Years', 'm_stay')}, {mode('Marital_Status', 'm_mar')}, {mode('Occupation', 'm_occ')},
freq AS (SELECT Product_Category_str AS label, count(*) AS n FROM tx GROUP BY 1),
top AS (SELECT label, n FROM freq ORDER BY n DESC, label LIMIT {top_cat}),
has_other AS (SELECT count(*) > {top_cat} AS yes FROM freq),
buckets AS (SELECT label AS bucket FROM top UNION ALL SELECT 'cat_other' FROM has_other WHERE yes),
users AS (SELECT DISTINCT User_ID FROM tx),
cells AS (SELECT t.User_ID, CASE WHEN t.Product_Category_str IN (SELECT label FROM top)
             THEN t.Product_Category_str ELSE 'cat_other' END AS bucket,
           count(t.Product_ID) AS n, sum(t.Purchase) AS r
          FROM tx t GROUP BY 1, 2),
grid AS (SELECT u.User_ID, k.bucket, COALESCE(c.n, 0) AS n, COALESCE(c.r, 0) AS r
         FROM users u CROSS JOIN buckets k LEFT JOIN cells c ON c.User_ID = u.User_ID AND c.bucket = k.bucket),
tot AS (SELECT User_ID, sum(n) AS nt, sum(r) AS rt FROM grid GROUP BY 1),
shares AS (SELECT g.User_ID, g.bucket,
             g.n / CASE WHEN t.nt = 0 THEN 1.0 ELSE CAST(t.nt AS DOUBLE) END AS share,
             g.r / CASE WHEN t.rt = 0 THEN 1.0 ELSE t.rt END AS rev_share,
             g.n, t.nt
           FROM grid g JOIN tot t USING (User_ID)),
ent AS (SELECT User_ID,
          CASE WHEN max(nt) <= 0 THEN 0.0 ELSE
            sum(-LEAST(GREATEST(share, 1e-12), 1.0) * ln(LEAST(GREATEST(share, 1e-12), 1.0))) END AS cat_entropy,
          CAST(sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_unique_categories
        FROM shares GROUP BY User_ID),
feats AS (SELECT b.*, COALESCE(a.v, 'Unknown') AS Age_mode, COALESCE(g.v, 'Unknown') AS Gender_mode,
    COALESCE(ci.v, 'Unknown') AS City_Category_mode,
    CAST(COALESCE(s.v, -1) AS SMALLINT) AS Stay_mode, CAST(COALESCE(ma.v, -1) AS SMALLINT) AS Marital_mode,
    CAST(COALESCE(oc.v, -1) AS SMALLINT) AS Occupation_mode,
    e.cat_entropy, e.n_unique_categories,
    ln(1 + b.avg_purchase) AS avg_purchase_log1p, ln(1 + b.median_purchase) AS median_purchase_log1p,
    ln(1 + b.std_purchase) AS std_purchase_log1p
  FROM basics b LEFT JOIN m_age a USING (User_ID) LEFT JOIN m_gender g USING (User_ID)
  LEFT JOIN m_city ci USING (User_ID) LEFT JOIN m_stay s USING (User_ID) LEFT JOIN m_mar ma USING (User_ID)
  LEFT JOIN m_occ oc USING (User_ID) LEFT JOIN ent e USING (User_ID))"""


def sql_features(select: str, variant: str = "clean") -> str:
    return f"WITH {feature_ctes(variant=variant)}\n{select}"


# ---------------------------------------------------------------------------
# Baskets and rules
# ---------------------------------------------------------------------------

BASKET_LINES = f"""bl AS (SELECT CAST(o.o_custkey AS INTEGER) AS User_ID,
    p.p_brand || '/' || p.p_type AS category_item, CAST(l.l_partkey AS VARCHAR) AS product_item
  FROM {STAR})"""

REGION = """asg AS (SELECT CAST(c.c_custkey AS INTEGER) AS User_ID, CAST(n.n_regionkey AS INTEGER) AS cluster
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _level_rows(level: str, item: str, segment: bool) -> str:
    if segment:
        return (f"SELECT 'cluster_' || CAST(a.cluster AS VARCHAR) || '_{level}' AS level, bl.User_ID, "
                f"bl.{item} AS item FROM bl JOIN asg a ON a.User_ID = bl.User_ID")
    return f"SELECT '{level}' AS level, User_ID, {item} AS item FROM bl"


PRODUCTION_LINES = f"""bl AS (SELECT User_ID, Product_ID AS product_item,
    'cat_' || COALESCE(CAST(CASE WHEN pc IS NULL OR isnan(pc) OR pc <> floor(pc) THEN NULL
                                 ELSE CAST(pc AS SMALLINT) END AS VARCHAR), 'unknown') AS category_item
  FROM (SELECT DISTINCT User_ID, Product_ID, TRY_CAST(Product_Category AS FLOAT) AS pc, Purchase
        FROM ({tx_raw()})))"""


def basket_ctes(specs: list[dict], lines: str | None = None) -> str:
    """CTEs up to ``kept`` (level, item, user_count), ``bk`` and ``bu`` for the given level specs.

    spec keys: level, item, segment, frac, abs, top_n, conf, lift.
    """
    rows = "\n    UNION ALL\n    ".join(_level_rows(s["level"], s["item"], s.get("segment", False)) for s in specs)
    params = " UNION ALL ".join(
        (f"SELECT {'level' if s.get('segment') else repr(s['level'])} AS level, "
         f"CAST({s['frac']} AS DOUBLE) AS frac, {s.get('abs') or 0} AS abs_floor, "
         f"{s.get('top_n') or 'NULL'} AS top_n, {str(bool(s.get('segment'))).upper()} AS use_base, "
         f"CAST({s['conf']} AS DOUBLE) AS min_conf, CAST({s['lift']} AS DOUBLE) AS min_lift"
         + (f" FROM (SELECT DISTINCT 'cluster_' || CAST(a.cluster AS VARCHAR) || '_{s['level']}' AS level "
            f"FROM asg a JOIN bl ON bl.User_ID = a.User_ID)" if s.get("segment") else ""))
        for s in specs)
    need_asg = any(s.get("segment") for s in specs)
    return f"""{lines or BASKET_LINES},{(' ' + REGION + ',') if need_asg else ''}
lr AS ({rows}),
par AS ({params}),
base AS (SELECT level, count(DISTINCT User_ID) AS base_users FROM lr WHERE User_ID IS NOT NULL GROUP BY level),
sub AS (SELECT DISTINCT level, User_ID, item FROM lr WHERE User_ID IS NOT NULL AND item IS NOT NULL),
nu AS (SELECT level, count(DISTINCT User_ID) AS n_users FROM sub GROUP BY level),
ic AS (SELECT level, item, count(*) AS user_count FROM sub GROUP BY level, item),
thr AS (SELECT nu.level, nu.n_users, base.base_users,
          GREATEST(1, CAST(ceil(par.frac * CAST(CASE WHEN par.use_base THEN base.base_users ELSE nu.n_users END AS DOUBLE)) AS BIGINT),
                   par.abs_floor) AS threshold, par.top_n, par.min_conf, par.min_lift
        FROM nu JOIN base USING (level) JOIN par USING (level)),
kept AS (SELECT level, item, user_count FROM (
           SELECT ic.level, ic.item, ic.user_count, thr.top_n,
                  ROW_NUMBER() OVER (PARTITION BY ic.level ORDER BY ic.user_count DESC, ic.item) AS rk
           FROM ic JOIN thr USING (level) WHERE ic.user_count >= thr.threshold)
         WHERE top_n IS NULL OR rk <= top_n),
bk AS (SELECT s.level, s.User_ID, s.item FROM sub s JOIN kept k USING (level, item)),
bu AS (SELECT level, count(DISTINCT User_ID) AS U FROM bk GROUP BY level)"""


def rules_ctes(specs: list[dict], lines: str | None = None) -> str:
    return f"""{basket_ctes(specs, lines)},
co AS (SELECT a.level, a.item AS item_a, b.item AS item_b, count(*) AS co
       FROM bk a JOIN bk b ON a.level = b.level AND a.User_ID = b.User_ID AND a.item < b.item
       GROUP BY 1, 2, 3),
dir AS (
  SELECT co.level, co.item_a AS antecedent, co.item_b AS consequent, co.co / CAST(bu.U AS DOUBLE) AS support,
         co.co / CAST(ka.user_count AS DOUBLE) AS confidence,
         (co.co / CAST(ka.user_count AS DOUBLE)) / (kb.user_count / CAST(bu.U AS DOUBLE)) AS lift
  FROM co JOIN kept ka ON ka.level = co.level AND ka.item = co.item_a
          JOIN kept kb ON kb.level = co.level AND kb.item = co.item_b JOIN bu ON bu.level = co.level
  UNION ALL
  SELECT co.level, co.item_b, co.item_a, co.co / CAST(bu.U AS DOUBLE),
         co.co / CAST(kb.user_count AS DOUBLE),
         (co.co / CAST(kb.user_count AS DOUBLE)) / (ka.user_count / CAST(bu.U AS DOUBLE))
  FROM co JOIN kept ka ON ka.level = co.level AND ka.item = co.item_a
          JOIN kept kb ON kb.level = co.level AND kb.item = co.item_b JOIN bu ON bu.level = co.level),
passed AS (SELECT d.* FROM dir d JOIN thr t USING (level) WHERE d.confidence >= t.min_conf AND d.lift >= t.min_lift),
dedup AS (SELECT level, antecedent, consequent, support, confidence, lift FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY level, LEAST(antecedent, consequent), GREATEST(antecedent, consequent)
                               ORDER BY confidence DESC, lift DESC, support DESC, antecedent) AS rn
  FROM passed) WHERE rn = 1)"""


RULE_SELECT = ("SELECT level, antecedent, consequent, ROUND(support, 6) AS support, "
               "ROUND(confidence, 6) AS confidence, ROUND(lift, 6) AS lift FROM {src}")

S_CATEGORY = dict(level="category", item="category_item", frac=0.04, conf=0.35, lift=1.25)
S_CATEGORY_LOOSE = dict(level="category", item="category_item", frac=0.04, conf=0.30, lift=1.05)
S_PRODUCT = dict(level="product", item="product_item", frac=0.02, conf=0.03, lift=1.30, top_n=40)
S_SEGMENT = dict(level="category", item="category_item", frac=0.05, conf=0.35, lift=1.25, abs=40, segment=True)
# reference production profile
P_CATEGORY = dict(level="category", item="category_item", frac=0.04, conf=0.35, lift=1.25)
P_PRODUCT = dict(level="product", item="product_item", frac=0.02, conf=0.35, lift=1.30, top_n=40)
PRODUCTION = [P_CATEGORY, P_PRODUCT, S_SEGMENT]


def sql_rules(specs, src="dedup", lines=None) -> str:
    return f"WITH {rules_ctes(specs, lines)}\n{RULE_SELECT.format(src=src)}"


def sql_top_rules(specs, n=200, order="lift") -> str:
    keys = ("lift DESC, confidence DESC, support DESC, LEAST(antecedent, consequent), "
            "GREATEST(antecedent, consequent), antecedent") if order == "lift" else \
        "LEAST(antecedent, consequent), GREATEST(antecedent, consequent), confidence DESC, lift DESC, support DESC"
    return f"""WITH {rules_ctes(specs)},
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY level ORDER BY {keys}) AS rank FROM dedup)
SELECT level, antecedent, consequent, ROUND(support, 6) AS support, ROUND(confidence, 6) AS confidence,
       ROUND(lift, 6) AS lift, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {n}"""


def sql_run_summary(specs, lines=None) -> str:
    return f"""WITH {rules_ctes(specs, lines)},
lv AS (SELECT DISTINCT level FROM par),
ni AS (SELECT level, count(*) AS n_items FROM kept GROUP BY level),
nr AS (SELECT level, count(*) AS n_rules FROM dedup GROUP BY level)
SELECT lv.level, CAST(COALESCE(nu.n_users, 0) AS BIGINT) AS n_users, CAST(COALESCE(ni.n_items, 0) AS BIGINT) AS n_items,
       CAST(COALESCE(nr.n_rules, 0) AS BIGINT) AS n_rules, 'PAIR' AS mode
FROM lv LEFT JOIN nu USING (level) LEFT JOIN ni USING (level) LEFT JOIN nr USING (level)"""


def sql_itemsets(specs: list[dict], max_len: dict | int = 3) -> str:
    """``fi``: itemsets up to ``max_len`` (a number, or one per level kind) with the level's own support."""
    longest = max_len if isinstance(max_len, int) else max(max_len.values())
    allowed = str(max_len) if isinstance(max_len, int) else \
        f"CASE WHEN level LIKE 'cluster%' THEN {max_len['segment']} ELSE {max_len['whole']} END"
    parts, unions = [], []
    for n in range(1, longest + 1):
        names = "abcdefgh"[:n]
        joins = "".join(f" JOIN bk {y} ON {y}.level = {x}.level AND {y}.User_ID = {x}.User_ID AND {x}.item < {y}.item"
                        for x, y in zip(names, names[1:]))
        items = ", ".join(f"{x}.item" for x in names)
        parts.append(f"s{n} AS (SELECT a.level, [{items}] AS items, count(*) AS freq FROM bk a{joins} GROUP BY 1, 2)")
        unions.append(f"SELECT * FROM s{n}")
    return f"""WITH {basket_ctes(specs)},
{", ".join(parts)},
sets AS ({" UNION ALL ".join(unions)}),
fi AS (SELECT s.level, s.items, s.freq, s.freq / CAST(bu.U AS DOUBLE) AS supp
       FROM sets s JOIN bu USING (level) JOIN (SELECT DISTINCT level, frac, min_conf, min_lift FROM par) p USING (level)
       WHERE s.freq / CAST(bu.U AS DOUBLE) >= p.frac AND len(s.items) <= {allowed})"""


def sql_itemsets_out(spec, max_len: int = 3) -> str:
    return (sql_itemsets([spec], max_len) +
            "\nSELECT level, array_to_string(items, ', ') AS itemset, CAST(len(items) AS INTEGER) AS n_items, "
            "CAST(freq AS BIGINT) AS freq FROM fi")


def sql_itemset_rules(specs, max_len: dict | int = 3) -> str:
    return sql_itemsets(specs, max_len) + """,
splits AS (
  SELECT level, items, supp, [items[1]] AS ante, [items[2]] AS cons FROM fi WHERE len(items) = 2
  UNION ALL SELECT level, items, supp, [items[2]], [items[1]] FROM fi WHERE len(items) = 2
  UNION ALL SELECT level, items, supp, [items[1]], [items[2], items[3]] FROM fi WHERE len(items) = 3
  UNION ALL SELECT level, items, supp, [items[2]], [items[1], items[3]] FROM fi WHERE len(items) = 3
  UNION ALL SELECT level, items, supp, [items[3]], [items[1], items[2]] FROM fi WHERE len(items) = 3
  UNION ALL SELECT level, items, supp, [items[2], items[3]], [items[1]] FROM fi WHERE len(items) = 3
  UNION ALL SELECT level, items, supp, [items[1], items[3]], [items[2]] FROM fi WHERE len(items) = 3
  UNION ALL SELECT level, items, supp, [items[1], items[2]], [items[3]] FROM fi WHERE len(items) = 3),
r AS (SELECT s.level, s.ante, s.cons, a.supp AS antecedent_support, c.supp AS consequent_support, s.supp AS support,
        s.supp / a.supp AS confidence, (s.supp / a.supp) / c.supp AS lift
      FROM splits s JOIN fi a ON a.level = s.level AND a.items = s.ante
                    JOIN fi c ON c.level = s.level AND c.items = s.cons)
SELECT level, array_to_string(ante, ', ') AS antecedent, array_to_string(cons, ', ') AS consequent,
       ROUND(antecedent_support, 6) AS antecedent_support, ROUND(consequent_support, 6) AS consequent_support,
       ROUND(support, 6) AS support, ROUND(confidence, 6) AS confidence, ROUND(lift, 6) AS lift
FROM r JOIN (SELECT DISTINCT level, min_conf, min_lift FROM par) p USING (level)
WHERE confidence >= min_conf AND lift >= min_lift"""



# ---------------------------------------------------------------------------
# Matrix, silhouette, niches, profiles
# ---------------------------------------------------------------------------

PLAIN_NUMERIC = ["n_transactions", "total_purchase", "avg_purchase", "median_purchase", "std_purchase",
                 "unique_products", "Stay_mode", "Marital_mode", "Occupation_mode", "cat_entropy",
                 "n_unique_categories", "avg_purchase_log1p", "median_purchase_log1p", "std_purchase_log1p"]
MATRIX_PLAIN = ["n_transactions", "unique_products", "cat_entropy", "n_unique_categories",
                "avg_purchase_log1p", "median_purchase_log1p", "std_purchase_log1p"]
MATRIX_PRED = ("(feature IN (" + ", ".join(f"'{c}'" for c in MATRIX_PLAIN) + ")"
               " OR feature LIKE 'cat_share__%' OR feature LIKE 'cat_rev_share__%')")


def matrix_ctes(q_low: float = 0.005, q_high: float = 0.995, variant: str = "clean") -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PLAIN_NUMERIC)
    return f"""{feature_ctes(variant=variant)},
nlong AS (
  SELECT User_ID, feature, value FROM (UNPIVOT (SELECT User_ID, {casts} FROM feats)
    ON {", ".join(PLAIN_NUMERIC)} INTO NAME feature VALUE value)
  UNION ALL SELECT User_ID, 'cat_share__' || bucket, share FROM shares
  UNION ALL SELECT User_ID, 'cat_rev_share__' || bucket, rev_share FROM shares),
wq AS (SELECT feature, quantile_cont(value, CAST({q_low} AS DOUBLE)) AS lo,
         quantile_cont(value, CAST({q_high} AS DOUBLE)) AS hi FROM nlong GROUP BY feature),
wlong AS (SELECT n.User_ID, n.feature, LEAST(GREATEST(n.value, q.lo), q.hi) AS value
          FROM nlong n JOIN wq q USING (feature)),
rq AS (SELECT feature, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
         quantile_cont(value, 0.75) AS q75 FROM wlong WHERE {MATRIX_PRED} GROUP BY feature),
rlong AS (SELECT w.User_ID, w.feature,
            (w.value - r.q50) / CASE WHEN r.q75 - r.q25 = 0 THEN 1.0 ELSE r.q75 - r.q25 END AS value
          FROM wlong w JOIN rq r USING (feature))"""


def sql_silhouette(metric: str) -> str:
    if metric == "manhattan":
        dist = "sum(abs(a.value - b.value))"
    else:
        dist = "sqrt(sum((a.value - b.value) * (a.value - b.value)))"
    return f"""WITH {matrix_ctes()}, {REGION},
lab AS (SELECT User_ID, cluster FROM asg WHERE User_ID IN (SELECT User_ID FROM rlong)),
pd AS (SELECT a.User_ID AS i, b.User_ID AS j, {dist} AS d
       FROM rlong a JOIN rlong b ON a.feature = b.feature AND a.User_ID <> b.User_ID GROUP BY 1, 2),
dc AS (SELECT pd.i, l.cluster AS cj, sum(pd.d) AS s FROM pd JOIN lab l ON l.User_ID = pd.j GROUP BY 1, 2),
sz AS (SELECT cluster, count(*) AS n FROM lab GROUP BY cluster),
ab AS (SELECT li.User_ID, li.cluster, szi.n AS n_own,
         max(CASE WHEN dc.cj = li.cluster THEN dc.s END) / CAST(szi.n - 1 AS DOUBLE) AS a,
         min(CASE WHEN dc.cj <> li.cluster THEN dc.s / CAST(szj.n AS DOUBLE) END) AS b
       FROM lab li JOIN sz szi ON szi.cluster = li.cluster
       LEFT JOIN dc ON dc.i = li.User_ID LEFT JOIN sz szj ON szj.cluster = dc.cj
       GROUP BY li.User_ID, li.cluster, szi.n)
SELECT User_ID, cluster, ROUND(a, 6) AS a, ROUND(b, 6) AS b,
       ROUND(CASE WHEN n_own <= 1 OR GREATEST(a, b) = 0 THEN 0.0 ELSE (b - a) / GREATEST(a, b) END, 6) AS silhouette
FROM ab"""


def sql_best_k() -> str:
    return f"""WITH {matrix_ctes()},
lab AS (SELECT CAST(c_custkey AS INTEGER) AS User_ID, CAST(k AS INTEGER) AS k, c_nationkey % k AS cluster
        FROM customer, range(2, 11) AS ks(k) WHERE CAST(c_custkey AS INTEGER) IN (SELECT User_ID FROM rlong)),
pd AS (SELECT a.User_ID AS i, b.User_ID AS j, sum(abs(a.value - b.value)) AS d
       FROM rlong a JOIN rlong b ON a.feature = b.feature AND a.User_ID <> b.User_ID GROUP BY 1, 2),
dc AS (SELECT l.k, pd.i, l.cluster AS cj, sum(pd.d) AS s FROM pd JOIN lab l ON l.User_ID = pd.j GROUP BY 1, 2, 3),
sz AS (SELECT k, cluster, count(*) AS n FROM lab GROUP BY 1, 2),
ab AS (SELECT li.k, li.User_ID, o.n AS n_own, max(CASE WHEN dc.cj = li.cluster THEN dc.s END) / CAST(o.n - 1 AS DOUBLE) AS a,
              min(CASE WHEN dc.cj <> li.cluster THEN dc.s / CAST(t.n AS DOUBLE) END) AS b
       FROM lab li JOIN sz o ON o.k = li.k AND o.cluster = li.cluster LEFT JOIN dc ON dc.k = li.k AND dc.i = li.User_ID
       LEFT JOIN sz t ON t.k = dc.k AND t.cluster = dc.cj GROUP BY li.k, li.User_ID, o.n),
score AS (SELECT k, avg(CASE WHEN n_own <= 1 OR GREATEST(a, b) = 0 THEN 0.0 ELSE (b - a) / GREATEST(a, b) END) AS s FROM ab GROUP BY k)
SELECT k, ROUND(s, 6) AS silhouette, row_number() OVER (ORDER BY s DESC, k) = 1 AS best FROM score"""


def sql_pairwise_within() -> str:
    return f"""WITH {matrix_ctes()}
SELECT a.User_ID AS a, b.User_ID AS b, ROUND(sum(abs(a.value - b.value)), 6) AS distance
FROM rlong a JOIN rlong b ON a.feature = b.feature AND a.User_ID < b.User_ID
GROUP BY a.User_ID, b.User_ID HAVING sum(abs(a.value - b.value)) <= 11.0"""


def given_leaves_ctes(members: bool = False) -> str:
    """``step(linkage, step, own, h)``: greedy merging of the nations' mean vectors; ``own``: each leaf's cluster.

    ``members``: by the average distance of all member pairs instead.
    """
    d = """d AS (SELECT la.i, lb.i AS j, sum(abs(a.v - b.v)) AS d, CAST(la.n AS DOUBLE) * lb.n AS w
      FROM mean a JOIN mean b ON a.feature = b.feature AND a.leaf < b.leaf JOIN leaf la ON la.leaf = a.leaf
      JOIN leaf lb ON lb.leaf = b.leaf GROUP BY la.i, lb.i, la.n, lb.n)"""
    if members:
        d = """far AS (SELECT a.leaf AS a, b.leaf AS b, sum(abs(a.value - b.value)) AS total
      FROM points a JOIN points b ON a.feature = b.feature AND a.leaf < b.leaf GROUP BY a.leaf, b.leaf),
d AS (SELECT la.i, lb.i AS j, total / (CAST(la.n AS DOUBLE) * lb.n) AS d, CAST(la.n AS DOUBLE) * lb.n AS w
      FROM far JOIN leaf la ON la.leaf = far.a JOIN leaf lb ON lb.leaf = far.b)"""

    def greedy(linkage: str, height: str) -> str:
        return f"""{linkage}(step, own, h) AS (
  SELECT 0, (SELECT list(i ORDER BY i) FROM leaf), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT step + 1, list_transform(own, lambda c: CASE WHEN c = m.b THEN m.a ELSE c END), m.h FROM (
    SELECT t.step, t.own, (SELECT struct_pack(a := a, b := b, h := h) FROM (
        SELECT least(t.own[d.i], t.own[d.j]) AS a, greatest(t.own[d.i], t.own[d.j]) AS b, {height} AS h
        FROM d WHERE t.own[d.i] <> t.own[d.j] GROUP BY 1, 2) ORDER BY h, a, b LIMIT 1) AS m
    FROM {linkage} t WHERE len(list_distinct(t.own)) > 1))"""
    return f"""WITH RECURSIVE {matrix_ctes()},
nat AS (SELECT CAST(c_custkey AS INTEGER) AS User_ID, CAST(c_nationkey AS BIGINT) AS leaf FROM customer),
points AS (SELECT leaf, User_ID, feature, value FROM rlong JOIN nat USING (User_ID)),
leaf AS (SELECT leaf, count(DISTINCT User_ID) AS n, row_number() OVER (ORDER BY leaf) AS i FROM points GROUP BY leaf),
mean AS (SELECT leaf, feature, avg(value) AS v FROM points GROUP BY 1, 2),
{d},
{greedy("average", "sum(d.d * d.w) / sum(d.w)")},
{greedy("complete", "max(d.d)")},
step AS (SELECT 'average' AS linkage, * FROM average UNION ALL SELECT 'complete', * FROM complete)"""


def sql_merge_heights() -> str:
    return given_leaves_ctes() + """
SELECT linkage, CAST(step - 1 AS INTEGER) AS step, ROUND(h, 6) AS height FROM step WHERE step > 0"""


def sql_merge_heights_true_average() -> str:
    return given_leaves_ctes(members=True) + """
SELECT CAST(step - 1 AS INTEGER) AS step, ROUND(h, 6) AS height, ROUND(h, 6) AS lower, ROUND(h, 6) AS upper
FROM step WHERE step > 0 AND linkage = 'average'"""


def sql_leaf_labels() -> str:
    return given_leaves_ctes() + """,
cut AS (SELECT linkage, len(list_distinct(own)) AS k, unnest(own) AS c, generate_subscripts(own, 1) AS i FROM step),
sized AS (SELECT linkage, k, c, sum(leaf.n) AS size, min(leaf.leaf) AS least FROM cut JOIN leaf USING (i) GROUP BY 1, 2, 3),
numbered AS (SELECT *, row_number() OVER (PARTITION BY linkage, k ORDER BY size DESC, least) - 1 AS label FROM sized)
SELECT cut.linkage, CAST(cut.k AS INTEGER) AS k, leaf.leaf, CAST(label AS INTEGER) AS label
FROM cut JOIN leaf USING (i) JOIN numbered USING (linkage, k, c) WHERE cut.k IN (2, 4, 10)"""


def sql_niche_split() -> str:
    return f"""WITH {BASKET_LINES}, {REGION},
users AS (SELECT DISTINCT User_ID FROM bl),
det AS (SELECT CAST(c.c_custkey AS INTEGER) AS User_ID, CAST(c.c_nationkey AS INTEGER) AS cluster
        FROM customer c WHERE CAST(c.c_custkey AS INTEGER) IN (SELECT User_ID FROM users)),
sz AS (SELECT cluster, count(*) AS size FROM det GROUP BY cluster),
tot AS (SELECT sum(size) AS total FROM sz),
niche AS (SELECT cluster FROM sz, tot WHERE size < 50 OR size / CAST(total AS DOUBLE) < 0.01),
core AS (SELECT d.User_ID FROM det d WHERE d.cluster NOT IN (SELECT cluster FROM niche)),
core_lab AS (SELECT a.User_ID, a.cluster FROM asg a WHERE a.User_ID IN (SELECT User_ID FROM core)),
core_rank AS (SELECT cluster, CAST(dense_rank() OVER (ORDER BY cluster) - 1 AS INTEGER) AS final
              FROM (SELECT DISTINCT cluster FROM core_lab)),
nl AS (SELECT count(*) AS next_label FROM core_rank),
niche_rank AS (SELECT cluster, CAST(dense_rank() OVER (ORDER BY cluster) - 1 AS INTEGER) AS r FROM niche)
SELECT c.User_ID, r.final AS cluster FROM core_lab c JOIN core_rank r USING (cluster)
UNION ALL
SELECT d.User_ID, CAST(n.r + nl.next_label AS INTEGER) AS cluster
FROM det d JOIN niche_rank n USING (cluster) CROSS JOIN nl"""


def sql_core_rows() -> str:
    return f"""WITH {BASKET_LINES},
users AS (SELECT DISTINCT User_ID FROM bl),
det AS (SELECT CAST(c.c_custkey AS INTEGER) AS User_ID, CAST(c.c_nationkey AS INTEGER) AS cluster
        FROM customer c WHERE CAST(c.c_custkey AS INTEGER) IN (SELECT User_ID FROM users)),
sz AS (SELECT cluster, count(*) AS size FROM det GROUP BY cluster),
tot AS (SELECT sum(size) AS total FROM sz),
niche AS (SELECT cluster FROM sz, tot WHERE size < 50 OR size / CAST(total AS DOUBLE) < 0.01),
seg AS (SELECT User_ID, CASE WHEN cluster IN (SELECT cluster FROM niche) THEN 'niche' ELSE 'core' END AS segment
        FROM det),
raw AS ({tx_raw()})
SELECT r.User_ID, r.Product_ID, r.Gender, r.Age, r.Occupation, r.City_Category,
       r.Stay AS Stay_In_Current_City_Years, r.Marital_Status, r.Product_Category,
       ROUND(CAST(r.Purchase AS DOUBLE), 4) AS Purchase, s.segment
FROM raw r JOIN seg s USING (User_ID)"""


def sql_cluster_profile() -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PLAIN_NUMERIC)
    return f"""WITH {feature_ctes()}, {REGION},
pl AS (SELECT User_ID, feature, value FROM (UNPIVOT (SELECT User_ID, {casts} FROM feats)
    ON {", ".join(PLAIN_NUMERIC)} INTO NAME feature VALUE value)
  UNION ALL SELECT User_ID, 'cat_share__' || bucket, share FROM shares
  UNION ALL SELECT User_ID, 'cat_rev_share__' || bucket, rev_share FROM shares)
SELECT a.cluster, pl.feature, CAST(count(pl.value) AS BIGINT) AS count, ROUND(avg(pl.value), 4) AS mean,
       ROUND(quantile_cont(pl.value, 0.5), 4) AS median
FROM pl JOIN asg a USING (User_ID) GROUP BY a.cluster, pl.feature"""


def sql_one_hot() -> str:
    cols = ["Age_mode", "Gender_mode", "City_Category_mode", "Stay_mode", "Marital_mode", "Occupation_mode"]
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col, CAST({c} AS VARCHAR) AS lvl FROM feats WHERE {c} IS NOT NULL" for c in cols)
    vals = " UNION ALL ".join(f"SELECT User_ID, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM feats" for c in cols)
    return f"""WITH {feature_ctes()},
lv AS ({levels}),
uv AS ({vals})
SELECT u.User_ID, lv.col || '=' || lv.lvl AS feature, CAST(CASE WHEN u.v = lv.lvl THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value
FROM uv u JOIN lv ON lv.col = u.col"""


def matrix_long_ctes(variant: str = "clean") -> str:
    """``x(User_ID, feature, value)``: the whole matrix. The modes are clipped like every number before they are encoded."""
    texts = " UNION ALL ".join(f"SELECT User_ID, '{c}' AS col, {c} AS v FROM feats" for c in ("Age_mode", "Gender_mode", "City_Category_mode"))
    return f"""{matrix_ctes(variant=variant)},
uv AS ({texts} UNION ALL SELECT User_ID, feature, CAST(value AS VARCHAR) FROM wlong
       WHERE feature IN ('Stay_mode', 'Marital_mode', 'Occupation_mode')),
lv AS (SELECT DISTINCT col, v FROM uv),
x AS (SELECT User_ID, feature, value FROM rlong UNION ALL
      SELECT u.User_ID, lv.col || '=' || lv.v, CASE WHEN u.v = lv.v THEN 1.0 ELSE 0.0 END FROM uv u JOIN lv ON lv.col = u.col)"""


def pca_ctes(done: str) -> str:
    """``axis(component, value, share, u)``: axes of the covariance until ``done``, a condition on the step's state.

    A covariance squared 40 times, with its trace kept at 1, is the projection on its first axis; its part is then
    taken off, and the next axis is looked for in the rest.
    """
    return f"""WITH RECURSIVE {matrix_long_ctes('planted')},
cell AS (SELECT a.feature AS f, b.feature AS g, covar_samp(a.value, b.value) AS v
         FROM x a JOIN x b ON a.User_ID = b.User_ID GROUP BY 1, 2),
line AS (SELECT f, list(v ORDER BY g) AS vs FROM cell GROUP BY f),
cov AS (SELECT list(vs ORDER BY f) AS c, list(f ORDER BY f) AS names FROM line),
start AS (SELECT c, list_sum([c[i][i] for i in range(1, len(c) + 1)]) AS t FROM cov),
run AS (
  SELECT 0 AS component, 0 AS sq, c, [[v / t for v in r] for r in c] AS m, t AS total, t AS rest,
         0.0::DOUBLE AS value, 0.0::DOUBLE AS share, NULL::DOUBLE[] AS u FROM start
  UNION ALL
  SELECT CASE WHEN sq < 40 THEN component ELSE component + 1 END, CASE WHEN sq < 40 THEN sq + 1 ELSE 0 END,
         c2, CASE WHEN sq < 40 THEN [[v / t2 for v in r] for r in m2] ELSE [[v / t2 for v in r] for r in c2] END,
         total, rest, l, share + l / total, u2
  FROM (SELECT *, CASE WHEN sq < 40 THEN list_sum([m2[i][i] for i in range(1, len(m2) + 1)])
                       ELSE list_sum([c2[i][i] for i in range(1, len(c2) + 1)]) END AS t2
    FROM (SELECT *, CASE WHEN sq < 40 THEN [[list_dot_product(r, s) for s in m] for r in m] END AS m2,
                 CASE WHEN sq < 40 THEN c ELSE [[c[i][j] - l * m[i][j] for j in range(1, len(c) + 1)] for i in range(1, len(c) + 1)] END AS c2,
                 CASE WHEN sq = 40 THEN [v / sqrt(m[p][p]) for v in m[p]] END AS u2
      FROM (SELECT *, CASE WHEN sq = 40 THEN list_sum([list_dot_product(c[i], m[i]) for i in range(1, len(c) + 1)]) ELSE 0 END AS l,
                   list_position([m[i][i] for i in range(1, len(m) + 1)], list_max([m[i][i] for i in range(1, len(m) + 1)])) AS p
            FROM run WHERE NOT (sq = 0 AND component > 0 AND ({done})))))),
axis AS (SELECT component, value, value / total AS ratio, share, u FROM run WHERE sq = 0 AND component > 0)"""


def sql_pca_variance() -> str:
    return pca_ctes("share > 0.8") + """
SELECT CAST(component AS INTEGER) AS component, ROUND(ratio, 6) AS explained_ratio, ROUND(share, 6) AS cumulative FROM axis"""


def sql_pca_components() -> str:
    return pca_ctes("share > 0.8") + """
SELECT CAST(component AS INTEGER) AS component, unnest(names) AS feature, ROUND(unnest(u), 6) AS loading FROM axis, cov"""


def sql_pca_projection() -> str:
    return pca_ctes("component = 3") + f""", {REGION},
load AS (SELECT component, unnest(names) AS feature, unnest(u) AS w FROM axis, cov),
mean AS (SELECT feature, avg(value) AS mu FROM x GROUP BY 1),
score AS (SELECT User_ID, component, sum((value - mu) * w) AS s FROM x JOIN mean USING (feature) JOIN load USING (feature) GROUP BY 1, 2),
wide AS (SELECT User_ID, max(s) FILTER (component = 1) AS pc1, max(s) FILTER (component = 2) AS pc2,
                max(s) FILTER (component = 3) AS pc3 FROM score GROUP BY 1)
SELECT w.User_ID, ROUND(pc1, 4) AS pc1, ROUND(pc2, 4) AS pc2, ROUND(pc3, 4) AS pc3, asg.cluster FROM wide w LEFT JOIN asg USING (User_ID)"""


def sql_cluster_profile_final() -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PLAIN_NUMERIC)
    return f"""WITH {feature_ctes()}, {REGION},
pl AS (SELECT User_ID, feature, value FROM (UNPIVOT (SELECT User_ID, {casts} FROM feats)
    ON {", ".join(PLAIN_NUMERIC)} INTO NAME feature VALUE value)
  UNION ALL SELECT User_ID, 'cat_share__' || bucket, share FROM shares
  UNION ALL SELECT User_ID, 'cat_rev_share__' || bucket, rev_share FROM shares),
grid0 AS (SELECT a.User_ID, a.cluster, f.feature FROM asg a CROSS JOIN (SELECT DISTINCT feature FROM pl) f)
SELECT g.cluster, g.feature, CAST(count(*) AS BIGINT) AS count, ROUND(avg(COALESCE(pl.value, 0)), 4) AS mean,
       ROUND(quantile_cont(COALESCE(pl.value, 0), 0.5), 4) AS median
FROM grid0 g LEFT JOIN pl ON pl.User_ID = g.User_ID AND pl.feature = g.feature GROUP BY g.cluster, g.feature"""


def oracles() -> dict[str, str]:
    """Query name -> DuckDB SQL."""
    feats = lambda sel: sql_features(sel)
    return {
        "clean_transactions": sql_clean(),
        "clean_transactions_dirty": sql_clean("dirty"),
        "dedupe_transactions": sql_clean("dup", 0.0, 1.0),
        "item_support": f"WITH {basket_ctes([S_CATEGORY])}\nSELECT level, item, CAST(user_count AS BIGINT) AS user_count FROM ic",
        "adaptive_threshold": f"WITH {basket_ctes([S_CATEGORY, S_PRODUCT, S_SEGMENT])}\n"
                              "SELECT level, CAST(n_users AS BIGINT) AS n_users, CAST(base_users AS BIGINT) AS base_users, "
                              "CAST(threshold AS BIGINT) AS threshold FROM thr",
        "basket_kept": f"WITH {basket_ctes([S_PRODUCT])}\nSELECT level, User_ID, item FROM bk",
        "pair_rules_category": sql_rules([S_CATEGORY]),
        "pair_rules_product": sql_rules([S_PRODUCT]),
        "pair_rules_segment": sql_rules([S_SEGMENT]),
        "pair_rules_both_directions": sql_rules([S_CATEGORY_LOOSE], "passed"),
        "pair_rules_deduped": sql_rules([S_CATEGORY_LOOSE]),
        "top_rules": sql_top_rules([S_CATEGORY_LOOSE]),
        "run_summary": sql_run_summary([S_CATEGORY, S_PRODUCT, S_SEGMENT]),
        "frequent_itemsets": sql_itemsets_out(S_CATEGORY),
        "frequent_itemsets_apriori": sql_itemsets_out(S_CATEGORY, 4),
        "itemset_rules": sql_itemset_rules([S_CATEGORY]),
        "itemset_rules_by_level": sql_itemset_rules([S_CATEGORY, S_SEGMENT], {"whole": 2, "segment": 3}),
        "top_categories": f"WITH {clean_ctes()},\nfreq AS (SELECT Product_Category_str AS label, count(*) AS n FROM tx GROUP BY 1)\n"
                          "SELECT label, CAST(n AS BIGINT) AS n FROM freq ORDER BY n DESC, label LIMIT 10",
        "user_basics": feats("SELECT User_ID, n_transactions, ROUND(total_purchase, 2) AS total_purchase, "
                             "ROUND(avg_purchase, 4) AS avg_purchase, ROUND(median_purchase, 4) AS median_purchase, "
                             "ROUND(std_purchase, 4) AS std_purchase, unique_products FROM basics"),
        "user_modes": feats("SELECT User_ID, Age_mode, Gender_mode, City_Category_mode, Stay_mode, Marital_mode, "
                            "Occupation_mode FROM feats"),
        "category_shares": feats("SELECT User_ID, bucket, ROUND(share, 6) AS share FROM shares"),
        "revenue_shares": feats("SELECT User_ID, bucket, ROUND(rev_share, 6) AS rev_share FROM shares"),
        "category_entropy": feats("SELECT User_ID, ROUND(cat_entropy, 6) AS cat_entropy, n_unique_categories FROM ent"),
        "user_features": feats(
            "SELECT User_ID, n_transactions, ROUND(total_purchase, 2) AS total_purchase, ROUND(avg_purchase, 4) AS avg_purchase, "
            "ROUND(median_purchase, 4) AS median_purchase, ROUND(std_purchase, 4) AS std_purchase, unique_products, "
            "Age_mode, Gender_mode, City_Category_mode, Stay_mode, Marital_mode, Occupation_mode, "
            "ROUND(cat_entropy, 6) AS cat_entropy, n_unique_categories, ROUND(avg_purchase_log1p, 6) AS avg_purchase_log1p, "
            "ROUND(median_purchase_log1p, 6) AS median_purchase_log1p, ROUND(std_purchase_log1p, 6) AS std_purchase_log1p "
            "FROM feats"),
        "user_features_dirty": sql_features(
            "SELECT User_ID, n_transactions, ROUND(total_purchase, 2) AS total_purchase, ROUND(avg_purchase, 4) AS avg_purchase, "
            "ROUND(median_purchase, 4) AS median_purchase, ROUND(std_purchase, 4) AS std_purchase, unique_products, "
            "Age_mode, Gender_mode, City_Category_mode, Stay_mode, Marital_mode, Occupation_mode, "
            "ROUND(cat_entropy, 6) AS cat_entropy, n_unique_categories FROM feats", "dirty"),
        "category_shares_dirty": sql_features("SELECT User_ID, bucket, ROUND(share, 6) AS share, "
                                              "ROUND(rev_share, 6) AS rev_share FROM shares", "dirty"),
        "winsorized_features": f"WITH {matrix_ctes()}\nSELECT User_ID, feature, CASE WHEN feature = 'total_purchase' "
                               "THEN ROUND(value, 2) WHEN feature IN ('avg_purchase', 'median_purchase', 'std_purchase') "
                               "THEN ROUND(value, 4) ELSE ROUND(value, 6) END AS value FROM wlong",
        "robust_scaled": f"WITH {matrix_ctes()}\nSELECT User_ID, feature, ROUND(value, 6) AS value FROM rlong",
        "one_hot_modes": sql_one_hot(),
        "feature_matrix_long": f"WITH {matrix_long_ctes()}\nSELECT User_ID, feature, ROUND(CAST(value AS DOUBLE), 6) AS value FROM x",
        "feature_covariance": f"WITH {matrix_long_ctes()}\nSELECT a.feature AS a, b.feature AS b, "
                              "ROUND(covar_samp(a.value, b.value), 4) AS cov FROM x a JOIN x b "
                              "ON a.User_ID = b.User_ID AND a.feature <= b.feature GROUP BY 1, 2",
        "pca_total_variance": f"WITH {matrix_long_ctes()}, v AS (SELECT feature, var_samp(value) AS v FROM x GROUP BY 1)\n"
                              "SELECT CAST(count(*) AS BIGINT) AS n_columns, ROUND(sum(v), 4) AS total_variance FROM v",
        "pca_variance": sql_pca_variance(),
        "pca_components": sql_pca_components(),
        "pca_projection": sql_pca_projection(),
        "cluster_profile_final": sql_cluster_profile_final(),
        "first_assignments": f"WITH s AS ({sql_niche_split()})\nSELECT * FROM s ORDER BY cluster, User_ID LIMIT 100",
        "production_rules_loose": sql_rules([s | {"conf": 0.02, "lift": 1.0} for s in PRODUCTION], lines=PRODUCTION_LINES),
        "l1_silhouette": sql_silhouette("manhattan"),
        "euclidean_silhouette": sql_silhouette("euclidean"),
        "best_k_given_labels": sql_best_k(),
        "merge_heights_given_leaves": sql_merge_heights(),
        "pairwise_manhattan_within": sql_pairwise_within(),
        "merge_heights_true_average": sql_merge_heights_true_average(),
        "labels_given_leaves": sql_leaf_labels(),
        "niche_split_given_labels": sql_niche_split(),
        "cluster_profile": sql_cluster_profile(),
        "core_rows_given_labels": sql_core_rows(),
        "production_rules": sql_rules(PRODUCTION, lines=PRODUCTION_LINES),
        "production_summary": sql_run_summary(PRODUCTION, lines=PRODUCTION_LINES),
        "production_item_support": f"WITH {basket_ctes(PRODUCTION, PRODUCTION_LINES)}\n"
                                   "SELECT level, item, CAST(user_count AS BIGINT) AS user_count FROM kept",
        "top_rules_pair_order": sql_top_rules([S_CATEGORY_LOOSE], 200, "pair"),
        "category_frequency": f"WITH {clean_ctes()}\nSELECT Product_Category_str AS label, CAST(count(*) AS BIGINT) AS n "
                              "FROM tx GROUP BY 1",
        "sample_assignments": f"WITH s AS ({sql_niche_split()})\nSELECT * FROM s ORDER BY cluster, User_ID LIMIT 5000",
    }
