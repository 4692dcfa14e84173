"""Parent/child queries over Timestep (orders) and Atom (lineitem)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import ATOM_SYMBOLS, cast_text_number, char_code, code_char, value_lookup_in_array
from ..operators import records as R
from ..session import scratch_path
from ..sources import files as FS
from ..sources import struct_records as SR
from .catalog import query
from .records import atom_sql, atom_view, timestep_sql, timestep_view


@query("child_ordinal", sql=atom_sql)
def q_child_ordinal(spark, sf_dir):
    """Ordinal of each child in its parent (skew-safe ranking), as the Atom table."""
    return atom_view(spark, sf_dir)


@query("reconcile_parent_child", sql=lambda: f"""
    SELECT CAST(SUM(CASE WHEN p.id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_parents,
           CAST(COALESCE(SUM(c.n), 0) AS BIGINT) AS n_children,
           CAST(SUM(CASE WHEN COALESCE(p.natoms, 0) <> COALESCE(c.n, 0) THEN 1 ELSE 0 END) AS BIGINT)
             AS n_mismatch,
           CAST(SUM(CASE WHEN p.id IS NULL THEN c.n ELSE 0 END) AS BIGINT) AS n_orphans
    FROM ({timestep_sql()}) p FULL OUTER JOIN
         (SELECT timestep, rank, COUNT(*) AS n FROM ({atom_sql()}) a GROUP BY timestep, rank) c
    ON p.id = c.timestep AND p.rank = c.rank""")
def q_reconcile_parent_child(spark, sf_dir):
    """Timestep.natoms must equal the number of its Atom rows (0 mismatches).

    Counting needs no ordinal, so the Atom rows are read without ``num``
    (no range shuffle): one partial + final count and one full outer join.
    """
    return R.reconcile_parent_child(timestep_view(spark, sf_dir), atom_base(spark, sf_dir),
                                    ["id", "rank"], ["timestep", "rank"])


def _draw_sql() -> str:
    return f"""
    SELECT id, rank, nsteps, CAST(CAST('0x' || substr(md5('0:' || rank || ':' || nsteps || ':' || id), 1, 8)
           AS BIGINT) % 4 + 4 AS INTEGER) AS natoms_draw
    FROM ({timestep_sql()}) t JOIN
         (SELECT rank, COUNT(*) AS nsteps FROM ({timestep_sql()}) x GROUP BY rank) r USING (rank)"""


@query("reconcile_declared_counts", sql=lambda: f"""
    SELECT COUNT(*) AS n_parents, CAST(SUM(COALESCE(c.n, 0)) AS BIGINT) AS n_children,
           CAST(SUM(CASE WHEN p.natoms_draw <> COALESCE(c.n, 0) THEN 1 ELSE 0 END) AS BIGINT) AS n_mismatch,
           CAST(0 AS BIGINT) AS n_orphans
    FROM ({_draw_sql()}) p LEFT JOIN
         (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c ON p.id = c.l_orderkey""")
def q_reconcile_declared_counts(spark, sf_dir):
    """J4 with counts declared by the keyed draw, independent of the children: most parents mismatch."""
    return R.reconcile_parent_child(q_keyed_draw(spark, sf_dir), atom_base(spark, sf_dir),
                                    ["id", "rank"], ["timestep", "rank"], count_col="natoms_draw")


@query("expand_children", sql=lambda: f"""
    SELECT id AS timestep, rank,
           CAST(CASE num WHEN 0 THEN 67 WHEN 1 THEN 79 WHEN 2 THEN 79 END AS TINYINT) AS symbol,
           CAST(num AS INTEGER) AS num,
           CAST(id AS DOUBLE) * 0.01::DOUBLE + CAST(num AS DOUBLE) * 0.01::DOUBLE AS x,
           CAST(id AS DOUBLE) * 0.02::DOUBLE + CAST(num AS DOUBLE) * 0.01::DOUBLE AS y,
           CAST(id AS DOUBLE) * 0.03::DOUBLE + CAST(num AS DOUBLE) * 0.01::DOUBLE AS z,
           CAST(id AS DOUBLE) * 0.01::DOUBLE AS force_x,
           CAST(id AS DOUBLE) * 0.02::DOUBLE AS force_y,
           CAST(id AS DOUBLE) * 0.03::DOUBLE AS force_z
    FROM (SELECT id, rank, unnest(range(natoms)) AS num FROM ({timestep_sql()}) t) e""")
def q_expand_children(spark, sf_dir):
    """Each Timestep -> natoms synthetic Atom rows (none for natoms = 0)."""
    return R.expand_children(timestep_view(spark, sf_dir))


@query("bytes_accounting", sql=lambda: f"""
    SELECT COALESCE(t.rank, a.rank) AS rank, COALESCE(t.nsteps, 0) AS nsteps, COALESCE(a.natoms, 0) AS natoms,
           COALESCE(t.nsteps, 0) * 24 + COALESCE(a.natoms, 0) * 72 AS bytes
    FROM (SELECT rank, COUNT(*) AS nsteps FROM ({timestep_sql()}) x GROUP BY rank) t
    FULL JOIN (SELECT CAST(l_orderkey % 7 AS INTEGER) AS rank, COUNT(*) AS natoms FROM lineitem GROUP BY 1) a
    ON t.rank IS NOT DISTINCT FROM a.rank""")
def q_bytes_accounting(spark, sf_dir):
    """bytes = nsteps * 24 + natoms * 72 per producer rank; a rank without steps or without atoms counts 0 of them."""
    return R.account_bytes(timestep_view(spark, sf_dir), atom_base(spark, sf_dir))


def atom_base(spark, sf_dir):
    """Atom rows without the ordinal (enough for counting)."""
    from ..session import read_table
    from .records import N_RANKS
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("timestep"),
        F.pmod(F.col("l_orderkey"), F.lit(N_RANKS)).cast("int").alias("rank"))


@query("keyed_draw", sql=_draw_sql)
def q_keyed_draw(spark, sf_dir):
    """Natoms drawn from (rank, nsteps, i): 4..7, independent of partitioning."""
    ts = timestep_view(spark, sf_dir)
    nsteps = ts.groupBy("rank").agg(F.count(F.lit(1)).alias("nsteps"))
    return ts.join(nsteps, "rank").select(
        "id", "rank", "nsteps", R.keyed_draw("rank", "nsteps", "id").alias("natoms_draw"))


@query("char_code", sql=lambda: f"""
    SELECT timestep, num, symbol, chr(symbol) AS symbol_char, CAST(ascii(chr(symbol)) AS INTEGER) AS code
    FROM ({atom_sql()}) a""")
def q_char_code(spark, sf_dir):
    """Numeric symbol code <-> character."""
    a = atom_view(spark, sf_dir)
    ch = code_char(F.col("symbol"))
    return a.select("timestep", "num", "symbol", ch.alias("symbol_char"),
                    char_code(ch).alias("code"))


@query("value_lookup_in_array", sql=lambda: f"""
    SELECT timestep, num,
           CASE num WHEN 0 THEN 'C' WHEN 1 THEN 'O' WHEN 2 THEN 'O' END AS sym,
           CASE num % 3 WHEN 0 THEN 'C' ELSE 'O' END AS sym_wrap
    FROM ({atom_sql()}) a""")
def q_value_lookup_in_array(spark, sf_dir):
    """``symbols[num]`` -- null past the end, or wrapped."""
    a = atom_view(spark, sf_dir)
    return a.select("timestep", "num",
                    value_lookup_in_array(F.col("num"), ATOM_SYMBOLS).alias("sym"),
                    value_lookup_in_array(F.col("num"), ATOM_SYMBOLS, wrap=True).alias("sym_wrap"))


@query("cast_text_number", sql=lambda: f"""
    SELECT id, printf('%f', energy) AS energy_text,
           CAST(printf('%f', energy) AS DOUBLE) AS energy,
           CAST(CAST(id AS VARCHAR) AS BIGINT) AS id_back,
           TRY_CAST(printf('%f', energy) || 'x' AS DOUBLE) AS bad
    FROM ({timestep_sql()}) t""")
def q_cast_text_number(spark, sf_dir):
    """Text -> number (``strtod``/``atoll``); malformed text gives null."""
    t = timestep_view(spark, sf_dir)
    txt = F.format_string("%f", F.col("energy"))
    return t.select("id", txt.alias("energy_text"), cast_text_number(txt).alias("energy"),
                    cast_text_number(F.col("id").cast("string"), "bigint").alias("id_back"),
                    cast_text_number(F.concat(txt, F.lit("x"))).alias("bad"))


@query("diff_paths", sql=lambda: f"""
    WITH src AS ({atom_sql()}),
    a AS (SELECT timestep, rank, symbol, num, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z,
                 round(force_x, 6) AS force_x, round(force_y, 6) AS force_y, round(force_z, 6) AS force_z FROM src),
    b AS (SELECT timestep, rank, symbol, num, {", ".join(
        f"round(CAST(printf('%f', {c}) AS DOUBLE), 6) AS {c}" for c in ("x", "y", "z", "force_x", "force_y", "force_z"))}
          FROM src)
    SELECT (SELECT COUNT(*) FROM a) AS rows_a, (SELECT COUNT(*) FROM b) AS rows_b,
           (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) d) AS only_a,
           (SELECT COUNT(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) d) AS only_b""")
def q_diff_paths(spark, sf_dir):
    """The Atom table sent by two transports (packed binary, CSV parts), compared row by row as read back.

    The ordinals come from a total order, so both transports rank the rows
    for themselves and nothing is kept in memory between them.
    """
    base = scratch_path(spark, "diff_paths")
    atoms = atom_view(spark, sf_dir)
    SR.write_struct(atoms, base + "/bin", SR.ATOM)
    FS.write_part_csv(atoms, base + "/csv")
    a = SR.scan_struct(spark, base + "/bin", SR.ATOM)
    b = FS.read_part_csv(spark, base + "/csv", SR.spark_schema(SR.ATOM))
    return R.diff_paths(a, b)
