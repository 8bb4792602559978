"""Column catalogs.

A catalog is a DataFrame with one row per (table, column)::

    table_name, ordinal, column_name, data_type, numeric_precision,
    numeric_scale, is_nullable, is_primary_key, has_default, default_value

It is built from a table's schema (driver-side metadata, one row per column --
bounded by the table's width, not its size) and, where observed facts are
wanted, from one aggregation pass over the data (null counts), so it can be
joined, diffed and aggregated like any other table.  On a cluster the same
shape comes from a JDBC read of ``information_schema``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shuffles_removed

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("numeric_precision", T.IntegerType()),
        T.StructField("numeric_scale", T.IntegerType()),
        T.StructField("is_nullable", T.BooleanType()),
        T.StructField("is_primary_key", T.BooleanType()),
        T.StructField("has_default", T.BooleanType()),
        T.StructField("default_value", T.StringType()),
    ]
)

IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*$"


def pg_type(dt: T.DataType) -> tuple[str, int | None, int | None]:
    """Source-database type name (and precision/scale) of a Spark type."""
    if isinstance(dt, T.LongType):
        return "bigint", None, None
    if isinstance(dt, T.IntegerType):
        return "integer", None, None
    if isinstance(dt, T.ShortType):
        return "smallint", None, None
    if isinstance(dt, T.DoubleType):
        return "double precision", None, None
    if isinstance(dt, T.FloatType):
        return "real", None, None
    if isinstance(dt, T.DecimalType):
        return "numeric", dt.precision, dt.scale
    if isinstance(dt, T.BooleanType):
        return "boolean", None, None
    if isinstance(dt, T.DateType):
        return "date", None, None
    if isinstance(dt, T.TimestampNTZType):
        return "timestamp without time zone", None, None
    if isinstance(dt, T.TimestampType):
        return "timestamp with time zone", None, None
    if isinstance(dt, T.BinaryType):
        return "bytea", None, None
    if isinstance(dt, T.ArrayType):
        return "ARRAY", None, None
    if isinstance(dt, (T.MapType, T.StructType, T.VariantType)):
        return "jsonb", None, None
    return "text", None, None


def default_for(dt: T.DataType, is_key: bool) -> str | None:
    """A representative declared default per type (as the source database
    reports it), used to exercise default handling."""
    name, _, _ = pg_type(dt)
    if is_key:
        return "nextval('id_seq'::regclass)"
    return {
        "text": "'n/a'::character varying",
        "double precision": "0",
        "integer": "0",
        "boolean": "false",
        "timestamp without time zone": "now()",
        "jsonb": "'{}'::jsonb",
    }.get(name)


def schema_rows(table: str, schema: T.StructType, keys: Sequence[str] = (), with_defaults: bool = False) -> list[tuple]:
    rows = []
    for i, f in enumerate(schema.fields, start=1):
        name, prec, scale = pg_type(f.dataType)
        is_key = f.name in keys
        default = default_for(f.dataType, is_key) if with_defaults else None
        rows.append((table, i, f.name, name, prec, scale, bool(f.nullable) and not is_key, is_key, default is not None, default))
    return rows


def catalog_of(spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None, with_defaults: bool = False) -> DataFrame:
    """Catalog rows of several tables from their schemas."""
    rows = []
    for name, df in tables.items():
        rows.extend(schema_rows(name, df.schema, (keys or {}).get(name, ()), with_defaults))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def null_profile(table: str, df: DataFrame) -> DataFrame:
    """One pass over the table: rows and NULLs per column, as catalog-shaped
    rows ``(table_name, column_name, n_rows, n_nulls)``."""
    cols = df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"__null_{i}") for i, c in enumerate(cols)],
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__null_{i}").alias("n_nulls")) for i, c in enumerate(cols)])
    return agg.select(F.lit(table).alias("table_name"), F.col("__n").alias("n_rows"), F.inline(pairs)).select(
        "table_name", "column_name", "n_rows", "n_nulls"
    )


def profiled_catalog(spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Catalog rows joined with the observed row and NULL counts."""
    cat = catalog_of(spark, tables, keys)
    prof = None
    for name, df in tables.items():
        p = null_profile(name, df)
        prof = p if prof is None else prof.unionByName(p)
    return cat.join(prof, ["table_name", "column_name"], "left")


def key_profile(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Does the declared key identify rows?  Counts per key are an
    aggregate (partial, map-side), then summarised in a second tiny one."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__c"))
    return per_key.agg(
        F.sum("__c").cast("long").alias("n_rows"),
        F.count("*").cast("long").alias("n_keys"),
        F.count(F.when(F.col("__c") > 1, 1)).cast("long").alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c"))), F.lit(0)).cast("long").alias("rows_in_duplicates"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*").withColumn(
        "is_unique", F.col("n_duplicate_keys") == 0
    )


PART_ROWS = 1 << 18  # rows of the part in which every set of columns is looked at first
SLICES = 64  # slices of a set's hashes, the first of which is searched before all
BATCH = 16  # sets that one pass over the table hashes; over the part, four times as many
RUN = 1 << 18  # rows whose hashes a task sorts at once
BUCKET = 1 << 20  # hashes that a task gathers at once
MANY = 1 << 20  # repeated hashes of a set up to which all their rows are looked up

Columns = tuple[str, ...]


def least_keys(df: DataFrame, max_width: int = 3, part_rows: int = PART_ROWS) -> list[Columns]:
    """S10 where no key is declared: the smallest sets of columns that identify the
    rows (all of the least width, none wider than ``max_width``; empty if there are
    none).  A column with a NULL is in no key.

    Sets are searched level by level, by 64-bit hashes of their values.  Two rows that
    agree on a set prove that neither it nor any other set of columns they agree on is a
    key; such a pair is first looked for among the rows of a part, then among the values
    of all rows in one slice of the hashes.  A set without such a pair has all its
    hashes compared.  If they differ, it is a key.  Rows of equal hashes are looked up
    and compared by value, and a wider set is settled by these few rows alone, as rows
    that differ in the narrower set differ in the wider one.

    A pass over all hashes shuffles eight bytes a row and set; its files go before the
    next pass."""
    n = df.count()
    if not n:
        return []
    search = _KeySearch(df, n, part_rows)
    with shuffles_removed(df.sparkSession):
        try:
            for width in range(1, min(max_width, len(df.columns)) + 1):
                found = search.keys(width)
                if found:
                    return found
            return []
        finally:
            for held in search.held:
                held.unpersist()


def _hash(some: Columns) -> F.Column:
    return F.xxhash64(*[F.col(c) for c in some])


def _repeats(df: DataFrame, some: Columns) -> bool:
    return bool(df.groupBy(*some).count().filter("count > 1").take(1))


def repeated_hashes(df: DataFrame, some: Columns, n: int) -> DataFrame:
    """``h``: the hashes of a set's values that more than one of the ``n`` rows have.

    Tasks sort the hashes of some rows and send them packed, by range; each range is
    gathered and sorted by one task.  Of any number of rows with one hash in a run, two
    are sent, so a value of many rows makes no large range."""
    bits = max(0, (n // BUCKET).bit_length())
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)

    def pack(held):
        h = np.sort(np.concatenate(held).view(np.uint64))
        h = h[np.concatenate([np.ones(min(2, len(h)), bool), h[2:] != h[:-2]])]
        at = [*np.searchsorted(h, edges), len(h)]
        pieces = [h[x:y].tobytes() for x, y in zip(at, at[1:])]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(edges))), pa.array(pieces, pa.binary())], ["bucket", "packed"])

    def packed(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += batch.num_rows
            if rows >= RUN:
                yield pack(held)
                held, rows = [], 0
        if rows:
            yield pack(held)

    def gathered(table):
        h = np.sort(np.frombuffer(b"".join(table["packed"].to_pylist()), np.uint64))
        return pa.table({"h": np.unique(h[1:][h[1:] == h[:-1]]).view(np.int64)})

    pieces = df.select(_hash(some).alias("h")).mapInArrow(packed, "bucket long, packed binary")
    return pieces.groupBy("bucket").applyInArrow(gathered, "h long")


class _KeySearch:
    """What is known of a table's keys, and the steps of ``least_keys``."""

    def __init__(self, df: DataFrame, n: int, part_rows: int):
        self.df, self.n, self.whole = df, n, n <= part_rows
        self.held: list[DataFrame] = []
        self.filled: dict[str, bool] = {}  # columns that were counted: without a NULL?
        self.agreeing: set[frozenset[str]] = set()  # columns that two rows agree on
        self.few: dict[Columns, int] = {}  # sets that are no keys: about how many values repeat
        self.rows: dict[Columns, DataFrame] = {}  # all rows that share their value of a set
        shares = -(-n // part_rows)
        self.part = self._numbered(df if self.whole else df.filter(F.pmod(_hash(df.columns), F.lit(shares)) == 0))

    def _hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist())
        return df

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """Rows kept for ``_pairs``, with an id and the hash of each column."""
        hashes = [F.xxhash64(c).alias(f"__{c}") for c in rows.columns]
        return self._hold(rows.select("*", F.monotonically_increasing_id().alias("__row"), *hashes))

    def _open(self, sets) -> list[Columns]:
        """The sets that may still be keys."""
        sets = [some for some in sets if all(self.filled.get(c, True) for c in some)]
        return [some for some in sets if not any(agree.issuperset(some) for agree in self.agreeing)]

    def _pairs(self, rows: DataFrame, sets: list[Columns]) -> list[Columns]:
        """The sets of which two of the rows have the same hash.  Of such a pair it is
        noted which columns they agree on, by value."""
        out = []
        columns = [c for c in rows.columns if not c.startswith("__")]
        for at in range(0, len(sets), 4 * BATCH):
            some = self._open(sets[at : at + 4 * BATCH])
            if not some:
                continue
            hashes = F.posexplode(F.array(*[F.xxhash64(*[F.col(f"__{c}") for c in s]) for s in some])).alias("set", "h")
            same = rows.select("__row", hashes).groupBy("set", "h").agg(F.min("__row").alias("a"), F.max("__row").alias("b")).filter("a < b")
            pairs = same.groupBy("set").agg(F.min("a").alias("a"), F.min_by("b", "a").alias("b")).collect()
            ids = {p[side] for p in pairs for side in "ab"}
            found = {r["__row"]: r for r in rows.filter(F.col("__row").isin(ids)).collect()} if ids else {}
            for p in pairs:
                x, y = found[p["a"]], found[p["b"]]
                self.agreeing.add(frozenset(c for c in columns if x[f"__{c}"] == y[f"__{c}"] and (x[c] == y[c] or x[c] != x[c])))
                out.append(some[p["set"]])
        return out

    def _settled(self, rows: DataFrame, sets: list[Columns]) -> list[Columns]:
        """The keys among sets whose repeats are all in the rows."""
        same = self._pairs(rows, sets)
        return [some for some in self._open(sets) if some not in same or not _repeats(rows, some)]

    def _without_nulls(self, sets: list[Columns]) -> list[Columns]:
        new = sorted({c for some in sets for c in some} - set(self.filled))
        if new:
            counts = self.df.agg(*[F.count(c).alias(c) for c in new]).first()
            self.filled.update({c: counts[c] == self.n for c in new})
        return self._open(sets)

    def _first_slice(self, sets: list[Columns]) -> dict[Columns, int]:
        """Sets with a repeated hash in the first slice, and one such hash."""
        out = {}
        for at in range(0, len(sets), BATCH):
            some = sets[at : at + BATCH]
            hashes = [_hash(s) for s in some]
            rows = self.df.filter(reduce(or_, [F.pmod(h, F.lit(SLICES)) == 0 for h in hashes]))
            rows = rows.select(F.posexplode(F.array(*hashes)).alias("set", "h")).filter(F.pmod("h", F.lit(SLICES)) == 0)
            same = rows.groupBy("set", "h").count().filter("count > 1")
            found = same.groupBy("set").agg(F.min("h").alias("h"), F.count("*").alias("c")).collect()
            out.update({some[r["set"]]: r["h"] for r in found})
            self.few.update({some[r["set"]]: r["c"] * SLICES for r in found})
        return out

    def _look_up(self, one: dict[Columns, int], all_of: dict[Columns, DataFrame]) -> DataFrame:
        """The rows that have the one hash of a set, or any of its repeated hashes."""
        rows, has = self.df, [_hash(some) == h for some, h in one.items()]
        for i, (some, hashes) in enumerate(all_of.items()):
            rows = rows.join(F.broadcast(hashes.select(F.col("h").alias(f"__h{i}"))), _hash(some) == F.col(f"__h{i}"), "left")
            has.append(F.col(f"__h{i}").isNotNull())
        return self._numbered(rows.filter(reduce(or_, has)).select(*self.df.columns))

    def _all_hashes(self, some: Columns) -> tuple[int, int | None, DataFrame]:
        """How many hashes of the set repeat, the least of them, and all."""
        hashes = self._hold(repeated_hashes(self.df, some, self.n))
        r = hashes.agg(F.count("*").alias("c"), F.min("h").alias("h")).first()
        return r["c"], r["h"], hashes

    def _by_shared_sets(self, sets: list[Columns]) -> list[Columns]:
        """Keys among the sets, where several hold a narrower one of few repeats:
        the rows of these, found in one pass, settle them all."""
        keys = []
        while True:
            parents = {p: [some for some in sets if set(p) < set(some)] for p, c in self.few.items() if c <= MANY // 2}
            best = max(parents, key=lambda p: (len(parents[p]), -self.few[p]), default=None)
            if best is None or len(parents[best]) < 3:
                return keys
            count, _, hashes = self._all_hashes(best)
            if count > MANY:
                self.few[best] = count
                continue
            del self.few[best]
            self.rows[best] = self._look_up({}, {best: hashes})
            keys += self._settled(self.rows[best], parents[best])
            sets = [some for some in sets if some not in parents[best]]

    def keys(self, width: int) -> list[Columns]:
        """The keys of this width, where there are no narrower ones."""
        sets = list(combinations(self.df.columns, width))
        if self.whole:
            return self._settled(self.part, self._without_nulls(sets))
        self._pairs(self.part, self._open(sets))
        sets = self._without_nulls(self._open(sets))
        keys = []
        for narrow, rows in self.rows.items():
            within = [some for some in sets if set(narrow) < set(some)]
            keys += self._settled(rows, within)
            sets = [some for some in sets if some not in within]
        suspect = self._first_slice(sets) if len(sets) > 1 else {}
        sets = [some for some in sets if some not in suspect]
        keys += (shared := self._by_shared_sets(sets))
        settled = [some for some in sets for p in self.rows if set(p) < set(some)]
        full = {}
        for some in self._open(sets):
            if some in shared or some in settled:
                continue
            count, least, hashes = self._all_hashes(some)
            if not count:
                keys.append(some)
            elif count <= MANY:
                full[some] = hashes
            else:
                suspect[some] = least
        while suspect or full:
            one = dict(list(suspect.items())[:BATCH])
            suspect = {some: h for some, h in suspect.items() if some not in one}
            rows = self._look_up(one, full)
            self.rows |= {some: rows for some in full}
            keys += self._settled(rows, list(full))
            self._pairs(rows, list(one))
            keys += [some for some in self._open(one) if not _repeats(self.df, some)]
            suspect, full = {some: suspect[some] for some in self._open(suspect)}, {}
        return [some for some in combinations(self.df.columns, width) if some in keys]


def reconcile(published: DataFrame, tracked: DataFrame, name: str = "table_name", schema_col: str = "schema_json") -> DataFrame:
    """Tables published by the source vs tables tracked here: added
    (published, untracked), removed (tracked, unpublished), schema missing
    (both, but no stored schema)."""
    pub = published.select(name).distinct()
    added = pub.join(tracked.select(name), name, "left_anti").withColumn("change", F.lit("added"))
    removed = tracked.select(name).distinct().join(pub, name, "left_anti").withColumn("change", F.lit("removed"))
    missing = (
        tracked.filter(F.col(schema_col).isNull() | (F.trim(F.col(schema_col)) == "") | (F.col(schema_col) == "{}"))
        .select(name)
        .join(pub, name, "left_semi")
        .withColumn("change", F.lit("schema_missing"))
    )
    return added.unionByName(removed).unionByName(missing)


def listing(catalog: DataFrame, name_filter: str | None = None) -> DataFrame:
    """Tables with their columns in ordinal order, optional
    case-insensitive name filter."""
    cat = catalog
    if name_filter:
        cat = cat.filter(F.col("table_name").ilike(f"%{name_filter}%"))
    extra = [F.max("n_rows").alias("n_rows")] if "n_rows" in cat.columns else []
    return cat.groupBy("table_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))), lambda s: s["column_name"]), ",").alias("columns"),
        F.count("*").alias("n_columns"),
        *extra,
    )


def target_check(candidates: DataFrame, existing: DataFrame, schema: str = "public") -> DataFrame:
    """S13 + J11: for each candidate target name: is it a valid identifier,
    does it exist in ``schema`` (exact or lower-case match), and if not, which
    other schema has it (first by name)."""
    ex = existing.select("schema_name", "table_name")
    here = ex.filter(F.col("schema_name") == schema).select(F.col("table_name").alias("__t"))
    elsewhere = ex.filter(F.col("schema_name") != schema).groupBy(F.lower("table_name").alias("__l")).agg(F.min("schema_name").alias("other_schema"))
    c = candidates.select("candidate").distinct()
    # Each spelling is a row of its own, so the lookup is an equi-join.
    spellings = c.select("candidate", F.explode(F.array_distinct(F.array("candidate", F.lower("candidate")))).alias("__t"))
    exact = spellings.join(here, "__t", "left_semi").select("candidate").distinct().withColumn("exists", F.lit(True))
    out = c.join(exact, "candidate", "left").join(elsewhere, F.lower(F.col("candidate")) == F.col("__l"), "left")
    return out.select(
        "candidate",
        F.col("candidate").rlike(IDENTIFIER).alias("valid_identifier"),
        F.coalesce("exists", F.lit(False)).alias("exists"),
        F.when(~F.coalesce("exists", F.lit(False)), F.col("other_schema")).alias("other_schema"),
    )


def warehouse_type(data_type, precision, scale, for_landing: bool = False):
    """Source type -> warehouse type, matched on whole type tokens
    (so INTERVAL or POINT do not read as INT)."""
    t = F.upper(F.trim(data_type))

    def has(token: str):
        return t.rlike(rf"(^|[^A-Z]){token}([^A-Z]|$)")

    numeric = F.when(precision.isNotNull() & scale.isNotNull(), F.format_string("NUMBER(%d, %d)", precision, scale)).otherwise("NUMBER(38,4)")
    return (
        F.when(has("SMALLINT") | has("INTEGER") | has("BIGINT") | has("INT") | has("INT2") | has("INT4") | has("INT8") | t.contains("SERIAL"), "NUMBER(38,0)")
        .when(has("NUMERIC") | has("DECIMAL"), numeric)
        .when(has("DOUBLE") | has("REAL") | has("FLOAT") | has("FLOAT4") | has("FLOAT8"), "FLOAT")
        .when(has("BOOLEAN") | has("BOOL"), "BOOLEAN")
        .when(has("DATE"), "DATE")
        .when(has("TIMESTAMPTZ") | t.contains("TIMESTAMP WITH TIME ZONE"), "TIMESTAMP_TZ")
        .when(has("TIMESTAMP"), "TIMESTAMP_NTZ")
        .when(has("TIMETZ") | has("TIME"), "TIME")
        .when(has("JSON") | has("JSONB"), "VARIANT")
        .when(has("ARRAY") | t.endswith("[]"), "ARRAY")
        .when(has("UUID"), "VARCHAR(36)")
        .when(has("GEOGRAPHY"), "VARCHAR" if for_landing else "GEOGRAPHY")
        .when(has("GEOMETRY"), "VARCHAR" if for_landing else "GEOMETRY")
        .otherwise("VARCHAR")
    )


def spark_type_name(data_type, precision, scale):
    """Source type -> Spark SQL type name for the decoded column."""
    t = F.upper(F.trim(data_type))
    return (
        F.when(t == "SMALLINT", "smallint")
        .when(t == "INTEGER", "int")
        .when(t == "BIGINT", "bigint")
        .when(t == "NUMERIC", F.format_string("decimal(%d,%d)", F.coalesce(precision, F.lit(38)), F.coalesce(scale, F.lit(4))))
        .when(t == "DOUBLE PRECISION", "double")
        .when(t == "REAL", "float")
        .when(t == "BOOLEAN", "boolean")
        .when(t == "DATE", "date")
        .when(t == "TIMESTAMP WITHOUT TIME ZONE", "timestamp_ntz")
        .when(t == "TIMESTAMP WITH TIME ZONE", "timestamp")
        .when(t == "BYTEA", "binary")
        .when(t == "ARRAY", "array<string>")
        .otherwise("string")
    )
