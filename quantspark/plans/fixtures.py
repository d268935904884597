"""The driver's star schema as a quantitative table: parts are features, nations samples, regions conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.operators import normalize, reshape, rollup
from quantspark.operators.filters import score_filter

QMAX = 0.05
#: Line items that one task of a large input holds.
TASK_ROWS = 250_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Dealt by the key to tasks of about ``TASK_ROWS`` line items each: their number grows with the input, their memory
    doesn't (partitions that Spark merges by their compressed size may hold millions). Small inputs stay as they are."""
    spark = df.sparkSession
    n = -(-rows // TASK_ROWS)
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), key) if n > spark.sparkContext.defaultParallelism else df


def long_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a line item, with canonical columns. Nations and regions are 25 and 5 rows at any scale.

    Orders meet their nation first and parts are joined last, by INDEX: line items move once by order and once by INDEX,
    by which large inputs stay partitioned for what goes on by feature.
    """
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.withColumn("rep", F.row_number().over(Window.partitionBy("r_name").orderBy("n_name"))).select("n_nationkey", "n_name", "r_name", "rep")
    table = read(spark, sf_dir, "lineitem")
    n = table.count()  # from the files' footers
    lines = table.select(F.col("l_partkey").cast("string").alias("INDEX"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part"), "p_name", "p_brand", "p_type", "p_size")
    if n > TASK_ROWS * spark.sparkContext.defaultParallelism:  # by its compressed file Spark would broadcast millions of parts
        parts = parts.hint("merge")
    runs = _dealt(orders, "o_custkey", n).join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name", "r_name", "rep")
    rows = _dealt(_dealt(lines, "l_orderkey", n).join(runs, F.col("l_orderkey") == F.col("o_orderkey")), "INDEX", n).join(parts, F.col("INDEX") == F.col("part"))
    return rows.select(
        "INDEX", F.col("n_name").alias("FILENAME"), F.col("r_name").alias("CONDITION"), F.col("rep").cast("long").alias("REPLICATE"),
        F.col("l_extendedprice").alias("SIGNAL"), F.col("l_discount").alias("QVALUE"), F.col("l_tax").alias("PEP"), F.col("l_linenumber").cast("int").alias("CHARGE"),
        F.concat(F.lit("_"), F.upper("p_type"), F.lit("["), "l_returnflag", F.lit("]"), "l_linestatus", F.lit("_")).alias("PEPTIDE_LSEQ"),
        F.col("l_quantity").alias("SPECTRAL_COUNTS"), F.col("p_size").cast("long").alias("PRECURSORS_EXP"), F.col("p_name").alias("GENE_NAMES"), F.col("p_brand").alias("FASTA_HEADERS"),
        (F.col("l_linestatus") == "O").alias("IS_COVARIATE"), F.col("p_brand").alias("PARENT_PROTEIN"),
        F.concat(F.col("l_tax").cast("string"), F.lit(";"), F.col("l_discount").cast("string")).alias("IBAQ"),
        F.col("l_orderkey").alias("ORDERKEY"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select(F.col("n_name").alias("Sample"), F.col("r_name").alias("CONDITION"), F.row_number().over(Window.partitionBy("r_name").orderBy("n_name")).cast("long").alias("REPLICATE"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_filter(long_table(spark, sf_dir), "QVALUE", QMAX)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.roll_up(kept(spark, sf_dir), "sum")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.complete_grid(cells(spark, sf_dir), samples(spark, sf_dir))


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INDEX, Sample, raw, v: log2 over the complete grid. Several steps read it, so it is persisted; a lost block is computed again."""
    return normalize.log_transform(grid(spark, sf_dir).withColumn("v", F.col("raw"))).persist()


def contrasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.operators.differential import contrast_table

    return contrast_table(samples(spark, sf_dir))


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 64 components of every vector as samples p00..p63 of one feature a vector."""
    v = read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("INDEX"), F.posexplode("embedding").alias("pos", "x"))
    return v.select("INDEX", F.format_string("p%02d", "pos").alias("Sample"), F.col("x").cast("double").alias("v"))


def _t_series(df: int = 20) -> str:
    """The sum in the closed form of the Student-t tail for even degrees of freedom (25 samples less 5 conditions: 20)."""
    weight, terms = 1.0, ["1"]
    for k in range(1, df // 2):
        weight *= (2 * k - 1) / (2 * k)
        terms.append(f"{weight!r} * pow({df} / ({df} + t * t), {k})")
    return " + ".join(terms)


T_SERIES = _t_series()


def odd_t_p(df: int) -> str:
    """The two-sided Student-t p-value of t for odd degrees of freedom, in SQL."""
    weight, terms, cosine = 1.0, [], f"sqrt({df} / ({df} + t * t))"
    for k in range(1, (df - 1) // 2 + 1):
        terms.append(f"{weight!r} * pow({cosine}, {2 * k - 1})")
        weight *= 2 * k / (2 * k + 1)
    return f"greatest(0, least(1, 1 - 2 / pi() * (atan(abs(t) / sqrt({df})) + abs(t) / sqrt({df} + t * t) * ({' + '.join(terms or ['0'])}))))"


def even_t_p(df: int) -> str:
    """The same for even degrees of freedom."""
    return f"greatest(0, least(1, 1 - abs(t) / sqrt({df} + t * t) * ({_t_series(df)})))"


def t_p(df: str, most: int) -> str:
    """The p-value of t for degrees of freedom in a column, 1 to ``most``."""
    return f"CASE {df} " + " ".join(f"WHEN {d} THEN {odd_t_p(d) if d % 2 else even_t_p(d)}" for d in range(1, most + 1)) + " END"


def _unit(salt: int) -> str:
    return f"(('0x' || substr(md5(\"INDEX\" || '|' || Sample || '|42|{salt}'), 1, 10))::BIGINT + 0.5) / 1099511627776"


#: Seeded noise of a cell, in SQL.
NOISE = f"sqrt(-2 * ln({_unit(1)})) * cos(2 * pi() * ({_unit(2)}))"

#: The same tables for DuckDB.
PRELUDE = f"""
WITH RECURSIVE nat AS (
  SELECT n_nationkey, n_name, r_name, row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS rep FROM nation JOIN region ON n_regionkey = r_regionkey
), long AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "INDEX", n_name AS FILENAME, r_name AS CONDITION, CAST(rep AS BIGINT) AS REPLICATE, l_extendedprice AS SIGNAL, l_discount AS QVALUE, l_tax AS PEP,
         l_linenumber AS CHARGE, '_' || upper(p_type) || '[' || l_returnflag || ']' || l_linestatus || '_' AS PEPTIDE_LSEQ, l_quantity AS SPECTRAL_COUNTS, CAST(p_size AS BIGINT) AS PRECURSORS_EXP,
         p_name AS GENE_NAMES, p_brand AS FASTA_HEADERS, l_linestatus = 'O' AS IS_COVARIATE, p_brand AS PARENT_PROTEIN, (l_tax + l_discount) / 2 AS ibaq, l_orderkey AS ORDERKEY
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nat ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
), kept AS (SELECT * FROM long WHERE QVALUE <= {QMAX}),
smp AS (SELECT n_name AS Sample, r_name AS CONDITION, CAST(rep AS BIGINT) AS REPLICATE FROM nat),
cells AS (SELECT "INDEX", FILENAME AS Sample, sum(SIGNAL) AS raw FROM kept GROUP BY ALL),
grid AS (SELECT f."INDEX", s.Sample, s.CONDITION, c.raw, CASE WHEN c.raw IS NOT NULL THEN log2(greatest(c.raw, 1e-10)) END AS v
         FROM (SELECT DISTINCT "INDEX" FROM cells) f CROSS JOIN smp s LEFT JOIN cells c ON c."INDEX" = f."INDEX" AND c.Sample = s.Sample),
contrasts AS (SELECT a.c || '_vs_' || b.c AS contrast, a.c AS A, b.c AS B FROM (SELECT DISTINCT CONDITION AS c FROM smp) a JOIN (SELECT DISTINCT CONDITION AS c FROM smp) b ON a.c < b.c),
eq AS (SELECT g."INDEX", g.Sample, g.CONDITION, g.raw, g.v * (t.m / s.m) AS v FROM grid g JOIN (SELECT Sample, median(v) AS m FROM grid GROUP BY ALL) s USING (Sample) CROSS JOIN (SELECT median(v) AS m FROM grid) t),
det AS (SELECT e."INDEX", e.Sample, e.CONDITION, e.raw, coalesce(e.v, q.q - 0.2) AS v, e.v IS NULL AS imputed FROM eq e JOIN (SELECT Sample, quantile_cont(v, 0.01) AS q FROM eq GROUP BY ALL) q USING (Sample)),
grp AS (SELECT "INDEX", CONDITION, avg(v) AS mean, count(v) AS n, coalesce(var_samp(v), 0) AS var FROM det GROUP BY ALL),
pooled AS (SELECT "INDEX", sum((n - 1) * var) / sum(n - 1) AS s2, sum(n - 1) AS df FROM grp GROUP BY ALL),
obs AS (SELECT "INDEX", CONDITION, count(raw) AS n_observed, count(*) - count(raw) AS n_missing FROM grid GROUP BY ALL),
st AS (SELECT a."INDEX", c.contrast, c.A, c.B, a.mean - b.mean AS log2fc, p.s2, p.df, sqrt(1.0 / a.n + 1.0 / b.n) AS factor, sqrt(p.s2) * sqrt(1.0 / a.n + 1.0 / b.n) AS se,
              (a.mean - b.mean) / (sqrt(p.s2) * sqrt(1.0 / a.n + 1.0 / b.n)) AS t
       FROM grp a JOIN contrasts c ON a.CONDITION = c.A JOIN grp b ON b."INDEX" = a."INDEX" AND b.CONDITION = c.B JOIN pooled p ON p."INDEX" = a."INDEX"),
pv AS (SELECT st.*, greatest(0, least(1, 1 - abs(t) / sqrt(20 + t * t) * ({T_SERIES}))) AS p FROM st),
emb AS (SELECT CAST(vec_id AS VARCHAR) AS "INDEX", printf('p%02d', i - 1) AS Sample, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i))
"""
