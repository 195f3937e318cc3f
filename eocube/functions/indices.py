"""Spectral indices by name, from the published index literature.

Formulas are expressions over letters (N near infrared, R red, G green, B blue,
S1 and S2 short-wave infrared, RE1 red edge, VV and VH radar) and constants with
defaults; a division by zero gives NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Published formulas.
FORMULAS = {
    "NDVI": "(N - R) / (N + R)",
    "GNDVI": "(N - G) / (N + G)",
    "NDWI": "(G - N) / (G + N)",
    "MNDWI": "(G - S1) / (G + S1)",
    "NDSI": "(G - S1) / (G + S1)",
    "NDMI": "(N - S1) / (N + S1)",
    "NBR": "(N - S2) / (N + S2)",
    "NBR2": "(S1 - S2) / (S1 + S2)",
    "NDBI": "(S1 - N) / (S1 + N)",
    "NDREI": "(N - RE1) / (N + RE1)",
    "EVI": "g * (N - R) / (N + C1 * R - C2 * B + L)",
    "EVI2": "g * (N - R) / (N + 2.4 * R + L)",
    "SAVI": "(1 + L) * (N - R) / (N + R + L)",
    "OSAVI": "(N - R) / (N + R + 0.16)",
    "MSAVI": "0.5 * (2 * N + 1 - sqrt(pow(2 * N + 1, 2) - 8 * (N - R)))",
    "ARVI": "(N - (R - gamma * (R - B))) / (N + (R - gamma * (R - B)))",
    "SR": "N / R",
    "DVI": "N - R",
    "CIG": "N / G - 1",
    "CIRE": "N / RE1 - 1",
    "VARI": "(G - R) / (G + R - B)",
    "BI": "((S1 + R) - (N + B)) / ((S1 + R) + (N + B))",
    "AWEInsh": "4 * (G - S1) - 0.25 * N + 2.75 * S2",
    "DpRVIVV": "4 * VH / (VV + VH)",
}
#: Published constants; SAVI's L differs.
CONSTANTS = {"g": 2.5, "C1": 6.0, "C2": 7.5, "L": 1.0, "gamma": 1.0}
SPECIAL = {"SAVI": {"L": 0.5}}
#: Usual band names and their letters.
LETTERS = {
    "blue": "B", "green": "G", "red": "R", "nir": "N", "nir08": "N2", "swir16": "S1", "swir22": "S2", "swir1": "S1", "swir2": "S2",
    "rededge1": "RE1", "rededge2": "RE2", "rededge3": "RE3", "coastal": "A", "yellow": "Y", "vv": "VV", "vh": "VH", "hh": "HH", "hv": "HV",
}

_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")
_FUNCTIONS = {"sqrt", "pow", "abs", "exp", "ln", "least", "greatest"}


def names_in(formula: str) -> set[str]:
    return {n for n in _NAME.findall(formula) if n.lower() not in _FUNCTIONS}


def available(bands: list[str]) -> list[str]:
    """Indices that bands with these names (or letters) are enough for."""
    have = {LETTERS.get(b, b) for b in bands} | set(CONSTANTS)
    return sorted(n for n, f in FORMULAS.items() if names_in(f) <= have)


def _safe(formula: str) -> str:
    """Each divisor that isn't a number is wrapped, so that zero gives NULL."""
    out, at = "", 0
    while (i := formula.find("/", at)) >= 0:
        out += formula[at : i + 1] + " "
        j = i + 1
        while formula[j] == " ":
            j += 1
        k, depth = j, 0
        while k < len(formula):
            depth += (formula[k] == "(") - (formula[k] == ")")
            if depth < 0 or depth == 0 and formula[k] in "+-*/" or depth == 0 and formula[k] == " ":
                break
            k += 1
            if depth == 0 and formula[k - 1] == ")":
                break
        out += f"nullif(cast({_safe(formula[j:k])} as double), 0)"
        at = k
    return out + formula[at:]


def expression(formula: str, columns: list[str], params: dict[str, str | float]) -> Column:
    """The formula with each name replaced by a band or a number; other names are refused."""

    def sub(m: re.Match) -> str:
        name = m[0]
        if name.lower() in _FUNCTIONS:
            return name
        value = params.get(name, name)
        if isinstance(value, (int, float)):
            return f"cast({float(value)!r} as double)"
        if value not in columns:
            raise ValueError(f"{name!r} is no band of the cube and has no value")
        return f"cast(`{value}` as double)"

    return F.expr(_substitute(_safe(formula), sub))


def _substitute(safe: str, sub) -> str:
    return _NAME.sub(lambda m: m[0] if m[0] in ("nullif", "cast", "as", "double") else sub(m), safe)


def add_indices(df: DataFrame, indices: list[str] | dict[str, str], **params: str | float) -> DataFrame:
    """A column for each index. ``params`` map letters to bands and constants to numbers; a dict of name and formula adds one's own."""
    if not indices:
        raise ValueError("no indices are given")
    auto = {LETTERS[b]: b for b in df.columns if b in LETTERS}
    new = {}
    for name in indices:
        formula = indices[name] if isinstance(indices, dict) else FORMULAS.get(name)
        if formula is None:
            raise ValueError(f"unknown index {name!r}")
        new[name] = expression(formula, df.columns, CONSTANTS | SPECIAL.get(name, {}) | auto | params)
    return df.withColumns(new)
