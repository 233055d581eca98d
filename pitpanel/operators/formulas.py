"""Predictor formula registry (UD1, OP1) and predictor-column discovery (PR7).

A formula is a Spark SQL expression over item columns (``CA``, ``TA`` …), the same items one fiscal
year before (``prev_TA``) and earlier predictors; it runs as a native Catalyst expression, no Python
UDF. Division by zero gives NULL (not an error, not infinity).
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.schemas import ITEM_NAMES, PREDICTOR_META_COLUMNS, item_column

PREVIOUS = "prev_"          # a name with this prefix is the item's value of the fiscal year before

# Words of a formula: white space and comments, quoted text, quoted names, numbers, names, signs.
_WORD = re.compile(r"""\s+|--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|"""
                   r"""(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[A-Za-z]*|[A-Za-z_]\w*|::|.""", re.S)


def _words(formula: str) -> list:
    return _WORD.findall(formula)


def _blank(word: str) -> bool:
    return word.isspace() or word.startswith(("--", "/*"))


def _is_name(word: str) -> bool:
    return word[0].isalpha() or word[0] == "_"


def names_used(formula: str) -> set:
    """Column and function names of a formula; quoted text and comments hold none."""
    return {w.strip("`") for w in _words(formula) if _is_name(w) or w[0] == "`"}


@dataclass(frozen=True)
class Predictor:
    name: str
    formula: str
    inputs: tuple = field(default_factory=tuple)   # item codes

    def needed_columns(self, known_names) -> set:
        """Item columns named by ``inputs`` plus every known name the formula
        mentions (so an input forgotten in ``inputs`` is still required); an item of
        the year before needs the item."""
        named = {item_column(c) for c in self.inputs}
        used = {n.removeprefix(PREVIOUS) for n in names_used(self.formula) if n.removeprefix(PREVIOUS) in known_names}
        return named | used

    def previous(self, known_names) -> set:
        """Items that the formula wants from the year before."""
        return {n.removeprefix(PREVIOUS) for n in names_used(self.formula)
                if n.startswith(PREVIOUS) and n.removeprefix(PREVIOUS) in known_names}

    def codes(self) -> set:
        by_name = {v: k for k, v in ITEM_NAMES.items()}
        used = {by_name[n.removeprefix(PREVIOUS)] for n in names_used(self.formula) if n.removeprefix(PREVIOUS) in by_name}
        return {int(c) for c in self.inputs} | used


# Accruals: (current assets - current liabilities - cash + short-term debt) / total assets.
ACC = Predictor("Acc", "(CA - CL - Cash + STD) / TA", (2201, 3101, 2003, 3051, 6699))
DEFAULT_REGISTRY = (ACC,)

# Further predictors from published papers, over the items of the dictionary (OP1; definitions adapted to them).
PUBLISHED_REGISTRY = (
    ACC,
    Predictor("AssetGrowth", "(TA - prev_TA) / prev_TA"),                                     # Cooper, Gulen, Schill 2008
    Predictor("AccrualsChange", "((CA - prev_CA) - (Cash - prev_Cash) - (CL - prev_CL) + (STD - prev_STD)) "
                                "/ ((TA + prev_TA) / 2)"),                                    # Sloan 1996
    Predictor("InventoryChange", "(Inv - prev_Inv) / ((TA + prev_TA) / 2)"),                  # Thomas, Zhang 2002
    Predictor("InventoryGrowth", "(Inv - prev_Inv) / prev_Inv"),                              # Belo, Lin 2012
    Predictor("InvestmentToAssets", "((PPE - prev_PPE) + (Inv - prev_Inv)) / prev_TA"),       # Lyandres, Sun, Zhang 2008
    Predictor("GrossProfitability", "(Sales - COGS) / TA"),                                   # Novy-Marx 2013
    Predictor("OperatingProfitability", "(Sales - COGS - SGA) / BE"),                         # Fama, French 2015
    Predictor("ReturnOnAssets", "NI / prev_TA"),                                              # Balakrishnan, Bartov, Faurel 2010
    Predictor("ReturnOnEquity", "NI / prev_BE"),                                              # Haugen, Baker 1996
    Predictor("NetOperatingAssets", "((TA - Cash) - (TL - STD)) / prev_TA"),                  # Hirshleifer et al. 2004
    Predictor("Leverage", "TL / TA"),                                                         # Bhandari 1988
    Predictor("NetDebt", "NDebt / TA"),                                                       # Penman, Richardson, Tuna 2007
    Predictor("SalesGrowth", "(Sales - prev_Sales) / prev_Sales"),                            # Lakonishok, Shleifer, Vishny 1994
    Predictor("SalesLessInventoryGrowth", "SalesGrowth - InventoryGrowth"),                   # Abarbanell, Bushee 1998
    Predictor("SalesLessSGAGrowth", "SalesGrowth - (SGA - prev_SGA) / prev_SGA"),             # Abarbanell, Bushee 1998
    Predictor("MarginChange", "(Sales - COGS) / Sales - (prev_Sales - prev_COGS) / prev_Sales"),   # Abarbanell, Bushee 1998
    Predictor("AssetTurnover", "Sales / TA"),                                                 # Soliman 2008
    Predictor("TurnoverChange", "Sales / TA - prev_Sales / prev_TA"),                         # Soliman 2008
    Predictor("TaxChange", "(Tax - prev_Tax) / prev_TA"),                                     # Thomas, Zhang 2011
    Predictor("EffectiveTax", "Tax / PreTax"),                                                # Abarbanell, Bushee 1998
    Predictor("CashHoldings", "Cash / TA"),                                                   # Palazzo 2012
    Predictor("EarningsYield", "EPS / Price"),                                                # Basu 1977
    Predictor("EarningsChange", "(EPS - prev_EPS) / abs(prev_EPS)"),                          # Ball, Brown 1968
    Predictor("Intangibles", "Intan / TA"),                                                   # Daniel, Titman 2006
    Predictor("CurrentRatio", "CA / CL"),                                                     # Ou, Penman 1989
    Predictor("CurrentRatioChange", "CA / CL - prev_CA / prev_CL"),                           # Ou, Penman 1989
    Predictor("BookEquityGrowth", "(BE - prev_BE) / prev_BE"),                                # Richardson et al. 2005
)


def registry_codes(registry) -> list:
    """Sorted distinct item codes the registry needs (DD4, driver-side: the
    registry is configuration, not data)."""
    return sorted({c for p in registry for c in p.codes()})


_CLOSING = {"(": ")", "[": "]"}


def _closed(words: list, i: int) -> int:
    """Where the bracket or CASE at ``i`` is closed (the place after it)."""
    depth = 0
    for j in range(i, len(words)):
        w = words[j].upper()
        depth += (w in _CLOSING or w == "CASE") - (w in _CLOSING.values() or w == "END")
        if depth == 0:
            return j + 1
    raise ValueError(f"unclosed {words[i]!r} in formula {''.join(words)!r}")


def _next(words: list, i: int) -> int:
    while i < len(words) and _blank(words[i]):
        i += 1
    return i


def _operand(words: list, i: int) -> int:
    """Where the operand that begins at ``i`` ends: signs, then a bracket, CASE, number, text, name or
    function call, and what is appended to it (members, places, casts)."""
    i = _next(words, i)
    while i < len(words) and words[i] in ("+", "-", "~"):
        i = _next(words, i + 1)
    if i == len(words):
        raise ValueError(f"a divisor is missing in formula {''.join(words)!r}")
    i = _closed(words, i) if words[i] == "(" or words[i].upper() == "CASE" else i + 1
    while (j := _next(words, i)) < len(words):
        if words[j] in _CLOSING and (words[j] == "[" or _is_name(words[i - 1])):
            i = _closed(words, j)
        elif words[j] in (".", "::"):
            i = _next(words, j + 1) + 1
        else:
            break
    return i


def null_on_zero(formula: str) -> str:
    """The formula with every divisor ``x`` of ``/``, ``%`` and ``div`` as ``nullif(x, 0)``, so that a division
    by zero is NULL whatever the session's ANSI setting. Quoted text and comments stay as they are."""
    words, out, i = _words(formula), [], 0
    while i < len(words):
        out.append(words[i])
        i += 1
        if words[i - 1] in ("/", "%") or (words[i - 1].lower() == "div" and i > 1 and words[i:i + 1] != ["("]):
            end = _operand(words, i)
            out.append(f" nullif({null_on_zero(''.join(words[i:end])).strip()}, 0)")
            i = end
    return "".join(out)


def with_previous(df: DataFrame, cols, company: str = "ws_id", freq: str = "freq", period: str = "fiscal_period",
                  known: str = "point_date", prefix: str = PREVIOUS) -> DataFrame:
    """Adds ``prev_<col>``: the value for the same company and frequency of the fiscal period numbered one less,
    as last known on the row's own date (no later restatement is used). Without such a
    row - a gap in the years, nothing known yet, a NULL key - it is NULL. Rows that repeat a key and date
    count once (the smallest values).

    The periods are first reduced to one row per key and date and joined with themselves on
    (company, frequency, period); the rows then take the result by key: no window over a company."""
    cols, keys = list(cols), [company, freq, period, known]
    one = df.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("v"))
    now = one.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    same = ((F.col("_0") == F.col(company)) & (F.col("_1") == F.col(freq)) & (F.col("_2") == F.col(period) + 1)
            & (F.col(known) <= F.col("_3")))
    found = (now.join(one, same).groupBy("_0", "_1", "_2", "_3").agg(F.max(F.struct(F.col(known).alias("k"), "v")).alias("l"))
             .select(*[F.col(f"_{i}").alias(k) for i, k in enumerate(keys)], *[F.col(f"l.v.{c}").alias(prefix + c) for c in cols]))
    return df.join(found, keys, "left")


def apply_registry(df: DataFrame, registry=DEFAULT_REGISTRY):
    """Evaluate predictors in order; later ones may use earlier results.

    A predictor whose inputs are missing is skipped with a warning.
    Returns ``(df, computed_names, skipped_names)``.
    """
    known = set(ITEM_NAMES.values()) | {p.name for p in registry}
    before = sorted(set().union(*[p.previous(known) for p in registry]) & set(df.columns))
    if before:
        df = with_previous(df, before)
    computed, skipped = [], []
    for p in registry:
        missing = sorted(c for c in p.needed_columns(known) | {PREVIOUS + c for c in p.previous(known)}
                         if c not in df.columns)
        if missing:
            warnings.warn(f"predictor {p.name} left out, no column {', '.join(missing)}")
            skipped.append(p.name)
            continue
        df = df.withColumn(p.name, F.expr(null_on_zero(p.formula)).cast("double"))
        computed.append(p.name)
    return df.drop(*[PREVIOUS + c for c in before]), computed, skipped


def predictor_columns(df: DataFrame) -> list:
    """Numeric columns that are not identifiers or dates (PR7)."""
    numeric = (T.DoubleType, T.LongType)
    return [f.name for f in df.schema.fields
            if f.name not in PREDICTOR_META_COLUMNS and isinstance(f.dataType, numeric)]
