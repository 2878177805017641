"""Mentions and relations of one text, as plain functions.

Arrow functions (``mentions``, ``relations``) and the grouped operator that reads tables
call them.  Tests hold them against Column expressions on the same rows.  A mention is a dict with type, value, start, end and, where they
apply, unit, value_num, value_pair and normalized.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

from quire.functions import vocabulary as V

_SUPER = str.maketrans(*V.SUPERSCRIPTS)
_SCALED = re.compile(r"([+-]?\d+(?:\.\d+)?)[xX]10\^?([+-]?\d+)")
_VALUE = re.compile(rf"({V.VALUE})\s*({V.UNIT})", re.I)
_CIE = re.compile(V.CIE, re.I)


@lru_cache(None)
def _word(word: str) -> re.Pattern:
    return re.compile(r"\b" + r"\s+".join(map(re.escape, word.split(" "))) + r"\b", re.I)


#: Letters whose lower case, to patterns that ignore case, is another one.
_FOLDED = str.maketrans("\u0130\u0131\u017f\u212a", "iisk")


def occurring(text: str, words) -> list[str]:
    """Those of the words that may occur in a text: the first part of each is in its lower-case form."""
    low = text.translate(_FOLDED).lower()
    return [w for w in words if w.partition(" ")[0] in low]


@lru_cache(None)
def _compiled(pattern: str) -> re.Pattern:
    flags = re.I if "(?iu)" in pattern else 0
    return re.compile(pattern.replace("(?U)", "").replace("(?iu)", ""), flags)


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def parse_number(raw: str) -> float | None:
    s = raw.replace(" ", "").translate(_SUPER).translate(str.maketrans("×−", "x-"))
    m = _SCALED.fullmatch(s)
    return float(m[1]) * 10.0 ** int(m[2]) if m else _number(s)


def normal_unit(unit: str) -> str:
    s = unit.strip().lower().replace(" ", "").translate(str.maketrans("·−⁻²", "*--2"))
    return V.UNIT_FORMS.get(s, unit.strip())


def _mention(type_: str, m: re.Match, value: str | None = None, **more) -> dict:
    return {"type": type_, "value": m[0] if value is None else value, "start": m.start(), "end": m.end(), **more}


def values(text: str) -> list[dict]:
    return [_mention("value", m, m[1], unit=normal_unit(m[2]), value_num=parse_number(m[1])) for m in _VALUE.finditer(text)]


def materials(text: str) -> list[dict]:
    hint, seen, out = _compiled("(?iu)" + V.MATERIAL_HINT), set(), []
    for pattern in V.MATERIALS:
        for m in _compiled(pattern).finditer(text):
            name, near = m[0], text[max(0, m.start() - V.MATERIAL_WINDOW) : m.end() + V.MATERIAL_WINDOW]
            known = name.upper() in V.NO_MATERIALS or re.match(V.PUBLICATION_NUMBER, name) or (m.span(), name) in seen
            if not known and (re.search(r"\d", name) or hint.search(near)):
                seen.add((m.span(), name))
                out.append(_mention("material", m, normalized=name.lower()))
    return out


def entities(text: str | None) -> list[dict]:
    text = text or ""
    out = values(text)
    for m in _CIE.finditer(text):
        a, b = (m[1], m[2]) if m[1] else (m[3], m[4])
        pair = [_number(a), _number(b)]
        out += [_mention("metric", m, "cie", value_pair=pair), _mention("value", m, f"{a},{b}", value_pair=pair)]
    words = dict.fromkeys(occurring(text, _KEYWORDS))
    out += [_mention("metric", m, w) for w in V.METRICS if w in words for m in _word(w).finditer(text)]
    out += materials(text)
    out += [_mention("device_layer", m, w, normalized=V.LAYERS[w]) for w in V.LAYERS if w in words for m in _word(w).finditer(text)]
    return out + [_mention("role", m, w) for w in V.ROLES if w in words for m in _word(w).finditer(text)]


_KEYWORDS = list(dict.fromkeys([*V.METRICS, *V.LAYERS, *V.ROLES]))


def first_keyword(text: str, words: list[str]) -> str | None:
    return next((w for w in words if _word(w).search(text)), None)


def alias_key(text: str | None) -> str:
    return re.sub("[^A-Za-z0-9]+", "", text or "").upper()


def fallback_id(text: str | None) -> str:
    raw = (text or "").strip().lower()
    return "mat:RAW" + (hashlib.sha1(raw.encode()).hexdigest()[:12].upper() if raw else "0" * 12)


def alias_pairs(text: str) -> list[tuple[str, str]]:
    out = []
    for pattern in V.ALIAS_PAIRS:
        for m in _compiled(pattern).finditer(text):
            names = left, right = m[1].strip(), m[2].strip()
            short = [n for n in names if re.search(V.ABBREVIATION, n)]
            canonical = short[0] if len(short) == 1 else min(names, key=lambda n: len(alias_key(n)))
            out += [(left, canonical), (right, canonical)]
    return out


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    cuts = [m.end() for m in re.finditer(V.SENTENCE_END, text)]
    return list(zip([0, *cuts], [*cuts, len(text)]))


def _inside(items: list[tuple[int, dict]], lo: int, hi: int) -> list[tuple[int, dict]]:
    return [(i, e) for i, e in items if e["start"] >= lo and e["end"] <= hi]


def relations(text: str, found: list[dict]) -> list[dict]:
    """All bindings of one text, in the order of the rules; mentions are named by their place in ``found``."""
    bounds, out = sentence_bounds(text), []
    by_type = lambda t: [(i, e) for i, e in enumerate(found) if e["type"] == t]
    add = lambda *x: out.append(dict(zip(("type", "source", "target", "rule", "distance", "sentence"), x)) | {"confidence": V.CONFIDENCE[x[3]]})
    metrics, vals, mats, roles, layers = map(by_type, ("metric", "value", "material", "role", "device_layer"))

    for sid, (lo, hi) in enumerate(bounds):
        own = _inside(metrics, lo, hi)
        for vi, v in _inside(vals, lo, hi) if own else ():
            pool = [x for x in own if x[1]["start"] <= v["start"]] or own
            mi, m = min(pool, key=lambda x: abs(v["start"] - x[1]["start"]))
            a, b = sorted((m["start"], v["start"]))
            if any(a < x["start"] < b for _, x in own):
                continue
            allowed = V.METRIC_UNITS.get(m["value"])
            rule = "cie_coord_inline" if m["value"] == "cie" and v.get("value_pair") else "nearest_metric"
            if v.get("unit") and allowed:
                if v["unit"].lower().replace(" ", "") not in allowed:
                    continue
                rule = "metric_unit_match"
            add("has_value", mi, vi, rule, b - a, sid)

    def wording(m: dict, r: dict, layer: bool) -> str | None:
        if m["end"] <= r["start"]:
            gap = text[m["end"] : r["start"]]
            if layer:
                return "pattern_material_in_layer" if len(gap) <= V.LAYER_GAP and re.search(V.IN_LAYER, gap, re.I) else None
            return "pattern_material_as_role" if len(gap) <= V.AS_GAP and re.search(V.ROLE_AS, gap, re.I) else None
        if not layer and r["end"] <= m["start"]:
            gap = text[r["end"] : m["start"]]
            return "pattern_role_material" if len(gap) <= V.FILLER_GAP and re.match(V.ROLE_FILLER, gap, re.I) else None
        return None

    bound: set[int] = set()
    for sid, (lo, hi) in enumerate(bounds):
        own = _inside(mats, lo, hi)
        for group, layer in ((roles, False), (layers, True)):
            for ri, r in _inside(group, lo, hi):
                near = [(abs(r["start"] - m["start"]), mi, rule) for mi, m in own if (rule := wording(m, r, layer))]
                if near:
                    d, mi, rule = min(near, key=lambda x: x[:2])
                    add("has_role", mi, ri, rule, d, sid)
                    if not layer:
                        bound.add(ri)

    def parts(lo: int, hi: int) -> list[tuple[int, int]]:
        cuts = [(m.start() + lo, m.end() + lo) for m in re.finditer(V.CHUNK_SPLIT, text[lo:hi], re.I)]
        return list(zip([lo, *(e for _, e in cuts)], [*(s for s, _ in cuts), hi]))

    sentences_ = [(sid, lo, hi) for sid, (lo, hi) in enumerate(bounds)]
    clauses = [(sid, a, b) for sid, lo, hi in sentences_ for a, b in parts(lo, hi)]
    for scopes, rule in ((clauses, "chunk_role_binding"), (sentences_, "nearest_role")):
        now = set(bound)
        for sid, lo, hi in scopes:
            own = _inside(mats, lo, hi)
            if len(own) == 1:
                mi, m = own[0]
                for ri, r in _inside(roles, lo, hi):
                    d = abs(r["start"] - m["start"])
                    if ri not in now and d <= V.ROLE_DISTANCE:
                        add("has_role", mi, ri, rule, d, sid)
                        bound.add(ri)
    return out


class Aliases:
    """Names of one document and the ids they stand for; texts are read in order."""

    def __init__(self):
        self.known = {alias_key(a): alias_key(c) for a, c in V.ALIASES.items()}
        self.ids: dict[str, str] = {}
        for key, canonical in self.known.items():
            self.ids.setdefault(canonical, f"mat:{canonical}")
            self.ids.setdefault(key, f"mat:{canonical}")

    def _key(self, name: str) -> str:
        key = alias_key(name)
        return self.known.get(key, key)

    def read(self, text: str) -> None:
        for alias, canonical in alias_pairs(text or ""):
            a, c = self._key(alias), self._key(canonical)
            if a and c:
                self.ids[c] = self.ids[a] = self.ids.get(a) or self.ids.get(c) or f"mat:{c}"

    def id_of(self, name: str) -> str:
        """The id of a mention; a new name becomes known."""
        key, mapped = alias_key(name), self._key(name)
        if not key:
            return fallback_id(name)
        self.ids[key] = self.ids[mapped] = self.ids.get(key) or self.ids.get(mapped) or f"mat:{mapped}"
        return self.ids[key]

    def promote(self, name: str) -> str:
        """A row's name gives the id; all names of its old id follow."""
        key, mapped = alias_key(name), self._key(name)
        if not key:
            return fallback_id(name)
        old, new = self.ids.get(key) or self.ids.get(mapped), f"mat:{mapped}"
        for k in [k for k, v in self.ids.items() if v == old and old != new]:
            self.ids[k] = new
        self.ids[key] = self.ids[mapped] = new
        return new
