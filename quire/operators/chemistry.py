"""Structures: tokens, circular fingerprints, Tanimoto similarity, substructure search.

Without a chemistry toolkit, structure strings are read by a small parser of the common
subset (organic atoms, brackets, bonds, branches, ring closures).  Fingerprints hash atom
environments up to two bonds away into 2,048 bits; they rank like circular fingerprints
but are not bit-compatible with any toolkit.  Substructure search matches atoms, bonds and
rings of a pattern of the same subset by backtracking.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, RADIUS = 2_048, 2
_TOKEN = re.compile(r"\[[^\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|%\d\d|\d|[-=#$:/\\.()~*]")
_BOND = {"-": 1, "/": 1, "\\": 1, "=": 2, "#": 3, "$": 4, ":": 1.5, "~": 0}


def parse(smiles: str) -> tuple[list[str], dict[tuple[int, int], float]] | None:
    """(atoms, bonds by atom pair); None if the string is not of the subset."""
    if "".join(_TOKEN.findall(smiles)) != smiles or not smiles:
        return None
    atoms, bonds, stack, rings, last, bond = [], {}, [], {}, None, None
    for t in _TOKEN.findall(smiles):
        if t == "(":
            stack.append(last)
        elif t == ")":
            if not stack:
                return None
            last = stack.pop()
        elif t == ".":
            last = None
        elif t in _BOND:
            bond = _BOND[t]
        elif t[0] == "%" or t.isdigit():
            if last is None:
                return None
            if t in rings:
                other, first = rings.pop(t)
                bonds[other, last] = bonds[last, other] = bond or first or _default(atoms[other], atoms[last])
            else:
                rings[t] = (last, bond)
            bond = None
        else:
            name = re.sub(r"^\[\d*|@+|H\d*(?=[+\-:\]])|[+\-]+\d*|:\d+|\]$", "", t) if t[0] == "[" else t
            atoms.append(name)
            if last is not None:
                order = bond if bond is not None else _default(atoms[last], name)
                bonds[last, len(atoms) - 1] = bonds[len(atoms) - 1, last] = order
            last, bond = len(atoms) - 1, None
    return None if stack or rings else (atoms, bonds)


def _default(a: str, b: str) -> float:
    return 1.5 if a[:1].islower() and b[:1].islower() else 1


def fingerprint(smiles: str | None) -> list[int] | None:
    """Set bits, ascending; null for what cannot be read."""
    found = parse(smiles) if smiles else None
    if not found or not found[0]:
        return None
    atoms, bonds = found
    near: list[list[tuple[float, int]]] = [[] for _ in atoms]
    for (a, b), order in bonds.items():
        near[a].append((order, b))
    codes = [zlib.crc32(f"{x}/{len(near[i])}".encode()) for i, x in enumerate(atoms)]
    bits = {c % BITS for c in codes}
    for _ in range(RADIUS):
        codes = [zlib.crc32(repr((codes[i], sorted((o, codes[j]) for o, j in near[i]))).encode()) for i in range(len(atoms))]
        bits |= {c % BITS for c in codes}
    return sorted(bits)


def contains(smiles: str | None, pattern: str) -> bool:
    """Whether the structure holds the pattern; ``*`` is any atom, ``~`` any bond."""
    whole, part = parse(smiles) if smiles else None, parse(pattern)
    if not whole or not part:
        return False
    (atoms, bonds), (want, links) = whole, part

    def fits(i: int, a: int, chosen: list[int]) -> bool:
        if want[i] != "*" and want[i] != atoms[a] or a in chosen:
            return False
        return all((chosen[j], a) in bonds and (not links[j, i] or bonds[chosen[j], a] == links[j, i]) for j in range(i) if (j, i) in links)

    def search(chosen: list[int]) -> bool:
        i = len(chosen)
        return i == len(want) or any(fits(i, a, chosen) and search([*chosen, a]) for a in range(len(atoms)))

    return search([])


def with_fingerprint(df: DataFrame, smiles: str = "smiles", out: str = "fp") -> DataFrame:
    @F.pandas_udf("array<int>")
    def bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(fingerprint)

    return df.withColumn(out, bits(F.col(smiles)))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared share of two sets given as arrays; null if both are empty or one is null."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(a.isNotNull() & b.isNotNull() & (either > 0), both / either)


def similar(molecules: DataFrame, smiles: str, k: int = 10, threshold: float = 0.0, key: str = "id", fp: str = "fp") -> DataFrame:
    """(key, score) of the ``k`` most similar molecules with at least ``threshold``."""
    bits = fingerprint(smiles)
    if bits is None:
        raise ValueError(f"cannot read structure {smiles!r}")
    score = tanimoto(F.col(fp), F.array(*map(F.lit, bits)))
    return molecules.select(key, score.alias("score")).where(F.col("score") >= threshold).orderBy(F.desc("score"), key).limit(k)


def with_substructure(molecules: DataFrame, pattern: str, k: int = 10, key: str = "id", smiles: str = "smiles") -> DataFrame:
    """The first ``k`` molecules, by key, that hold the pattern; atoms are tested before Python is."""
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: contains(x, pattern))

    elements = sorted({a for a in (parse(pattern) or ([], {}))[0] if a != "*"})
    cheap = F.lit(True)
    for a in elements:
        cheap = cheap & F.col(smiles).contains(a)
    return molecules.where(cheap).where(holds(F.col(smiles))).orderBy(key).limit(k)
