"""Check, take apart, put together and normalise index columns."""
from pyspark.sql import DataFrame

from ..functions import bits
from ..functions.steps import run, scoped
from .topology import audit_vertices


def audit_index(df: DataFrame, index="cell", vertices=False) -> DataFrame:
    """Parts and validity of each index.  Parts are read from the bits whether or not the
    index is valid; ``vertices`` adds is_valid_vertex and is_valid_index, which need
    the geometry of the owner."""
    out = run(df, [], {
        "resolution": bits.resolution_of(index), "base_cell": bits.base_cell_of(index),
        "is_valid_cell": bits.is_valid_cell(index), "is_valid_edge": bits.is_valid_edge(index),
        "is_pentagon": f"({bits.is_pentagon(index)})", "is_class_iii": bits.is_class_iii(index)})
    if vertices:
        out = audit_vertices(out, index, "is_valid_vertex")
        out = out.selectExpr("*", "is_valid_cell OR is_valid_edge OR is_valid_vertex AS is_valid_index")
    return out


def index_digits(df: DataFrame, index="cell", r="r", out="digit") -> DataFrame:
    """Digit of each index at a level (number or column); NULL outside 1-15."""
    return run(df, [], {out: bits.digit(index, r)})


def split_valid(df: DataFrame, index="cell"):
    """(valid, quarantine) rows by cell validity; NULL goes to quarantine."""
    ok = f"coalesce({bits.is_valid_cell(index)}, false)"
    return df.filter(ok), df.filter(f"NOT {ok}")


def normalise_keys(df: DataFrame, key="key", out="cell") -> DataFrame:
    """Any key column to canonical BIGINT: hex text, BIGINT, or unsigned as DECIMAL.
    What cannot be an index (not hex, top bit set) becomes NULL."""
    kind = df.select(key).schema[0].dataType.simpleString()
    if kind == "string":
        expr = bits.parse_hex(key)
    elif kind.startswith("decimal"):
        expr = f"CASE WHEN {key} BETWEEN 0 AND 9223372036854775807 THEN CAST({key} AS BIGINT) END"
    else:
        expr = f"CAST({key} AS BIGINT)"
    return run(df, [], {out: expr})


def hex_keys(df: DataFrame, index="cell", out="hex") -> DataFrame:
    return run(df, [], {out: bits.to_hex(index)})


def assemble_cells(df: DataFrame, base="base", digits="digits", res=None, out="cell") -> DataFrame:
    """Cells from base cell number and digit array; ``res`` defaults to the array's length."""
    steps, result = scoped(*bits.assemble(base, digits, res or f"size({digits})"))
    return run(df, steps, {out: f"CASE WHEN {digits} IS NOT NULL THEN {result} END"})
