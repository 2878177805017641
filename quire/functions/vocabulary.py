"""The words, patterns and constants that results are defined by.

Patterns are Java regular expressions; ``(?U)`` makes classes and word boundaries follow
Unicode, ``(?iu)`` ignores case beyond ASCII.
"""

# Headings of sections; the first one that occurs anywhere in a text counts.
SECTIONS = {
    "abstract": [r"\babstract\b", r"摘要"],
    "claims": [r"\bclaims?\b", r"权利要求书", r"权利要求"],
    "description": [r"\bdescription\b", r"说明书"],
    "background": [r"\bbackground\b", r"背景技术"],
    "summary": [r"\bsummary\b", r"发明内容"],
    "drawings_desc": [r"\bbrief description of the drawings\b", r"附图说明"],
    "detailed_desc": [r"\bdetailed description\b", r"具体实施方式"],
}
# Sections that are parts of the description.
SUBSECTIONS = ("background", "summary", "drawings_desc", "detailed_desc")
# Kinds of examples, tried after the sections.
EXAMPLES = {
    "synthesis_example": [r"\b(synthesis|preparation)\s+example\b", r"合成例", r"制备例"],
    "device_example": [r"\bdevice\s+example\b", r"器件例"],
    "comparative_example": [r"\bcomparative\s+example\b", r"对比例"],
    "effect_statement": [r"\beffect\b", r"效果", r"有益效果"],
    "example": [r"\bexample\s*\d+\b", r"实施例\s*[0-9A-Za-z\-]+"],
}
EXAMPLE_WORDS = (
    r"实施例|对比例|合成例|制备例|器件例|"
    r"example|comparative\s+example|synthesis\s+example|preparation\s+example|device\s+example"
)

CLAIM_LINE = r"^\s*(?:claim\s*|claims?\s*|权利要求\s*)?(\d+)\s*(?:[\.\、:：)]|\b)\s*(.+)$"
CLAIM_LABEL = r"^\s*(?:claim|claims?|权利要求)\s*(\d+)\s*[\.\、:：)]?\s*(.+)$"
CLAIM_DEPENDS = r"(?:claim|claims|权利要求)\s*(\d+(?:\s*(?:to|至|-|and|or|、|和)\s*\d+)*)"
FIGURE_NO = r"\b(?:fig(?:ure)?|图)\s*\.?\s*(\d+[a-zA-Z]?)"
TABLE_NO = r"\b(?:table|表)\s*\.?\s*(\d+[a-zA-Z]?)"
REFERENCE_NUMERAL = r"([A-Za-z一-龥][A-Za-z一-龥\s\-]*)\s*\((\d+)\)"
INID_LINE = r"^\s*[\[\(](\d{2})[\]\)]\s*(.*)$"

METRICS = [
    "eqe", "ce", "pe", "current efficiency", "power efficiency", "luminance",
    "t50", "lt50", "lifetime", "turn-on voltage", "voltage", "cie",
]
# Units, lower case and without spaces, that a value of a metric may have.
METRIC_UNITS = {
    "eqe": ["%"],
    "ce": ["cd/a", "cd/a."],
    "current efficiency": ["cd/a"],
    "power efficiency": ["lm/w"],
    "pe": ["lm/w"],
    "luminance": ["cd/m2", "cd*m-2", "cdm-2"],
    "t50": ["h", "hr", "hours"],
    "lt50": ["h", "hr", "hours"],
    "lifetime": ["h", "hr", "hours"],
    "turn-on voltage": ["v"],
    "voltage": ["v"],
}
CONFIDENCE = {
    "cie_coord_inline": 0.95,
    "metric_unit_match": 0.85,
    "nearest_metric": 0.65,
    "nearest_role": 0.70,
    "chunk_role_binding": 0.82,
    "pattern_material_as_role": 0.93,
    "pattern_role_material": 0.92,
    "pattern_material_in_layer": 0.9,
    "table_row_key_binding": 0.92,
    "table_col_binding": 0.95,
    "table_role_column": 0.9,
}
CIE = r"cie(?:\s*1931)?\s*(?:[\(\[]\s*([0-9.]+)\s*[,，]\s*([0-9.]+)\s*[\)\]]|\s+([0-9.]+)\s*[,，]\s*([0-9.]+))"
VALUE = (
    r"[-+]?\d+(?:\.\d+)?"
    r"(?:\s*(?:×|x|X)\s*10(?:\^)?\s*[-+−⁻⁺]?(?:\d+|[⁰¹²³⁴⁵⁶⁷⁸⁹]+)|[eE][-+]?\d+)?"
)
UNIT = (
    r"cd\s*/\s*m(?:2|²)|cd\s*[*·]?\s*m(?:-2|⁻²)|mA\s*/\s*cm(?:2|²)|A\s*/\s*cm(?:2|²)|A\s*/\s*m(?:2|²)"
    r"|mW\s*/\s*cm(?:2|²)|cd\s*/\s*A|lm\s*/\s*W|V|nm|eV|%|h|hr|hours|K|°C|C"
)
# Spellings, lower case without spaces, of units with a normal form; others stay as written.
UNIT_FORMS = {
    "cd/m2": "cd/m2", "cd*m-2": "cd/m2", "ma/cm2": "mA/cm2", "a/cm2": "A/cm2", "a/m2": "A/m2",
    "mw/cm2": "mW/cm2", "cd/a": "cd/A", "lm/w": "lm/W", "ev": "eV", "hr": "hr",
}
SUPERSCRIPTS = ("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")

LAYERS = {
    "htl": "hole_transport_layer",
    "etl": "electron_transport_layer",
    "eml": "emission_layer",
    "hil": "hole_injection_layer",
    "eil": "electron_injection_layer",
    "hbl": "hole_blocking_layer",
    "ebl": "electron_blocking_layer",
    "anode": "anode",
    "cathode": "cathode",
}
ROLES = [
    "host", "host material", "dopant", "guest", "guest material", "emitter", "light-emitting material",
    "acceptor", "donor", "hole transport", "hole transporting", "htl", "electron transport",
    "electron transporting", "etl", "hole injection", "hil", "electron injection", "eil",
    "hole blocking", "hbl", "exciton blocking", "ebl", "injection",
]

# Names of materials: formulas, abbreviations, bracketed complexes, numbered compounds.
MATERIALS = [
    r"(?U)\b(?:[A-Z][a-z]?\d+)+\b",
    r"(?U)\b(?:[A-Z]{2,}[A-Za-z0-9\-]{1,}|[a-z][A-Z][A-Za-z0-9\-]{1,24})\b",
    r"(?U)(?iu)\b(?:fac|mer)?-?[A-Z][a-z]?(?:\([A-Za-z0-9+\-]{1,24}\)){1,3}\d{0,3}\b",
    r"(?U)(?iu)\b(?:Compound|Cmpd\.?)\s*[A-Za-z0-9]+\b",
]
NO_MATERIALS = ("FIG", "TABLE", "EXAMPLE", "OLED", "PCT", "WO", "US", "EP")
PUBLICATION_NUMBER = r"^[A-Z]{2}\d{4,}[A-Z0-9]*$"
MATERIAL_HINT = (
    r"\b(host|dopant|emitter|acceptor|donor|compound|material|layer|htl|etl|eml|hil|eil|hbl|ebl)\b"
    r"|主体|客体|掺杂|化合物|材料|传输层|发光层|注入层"
)
MATERIAL_WINDOW = 48
# Spellings of materials with a known abbreviation.
ALIASES = {
    "4,4'-bis(carbazol-9-yl)biphenyl": "CBP",
    "4,4-bis(carbazol-9-yl)biphenyl": "CBP",
    "N,N'-di(1-naphthyl)-N,N'-diphenylbenzidine": "NPB",
    "2,2',2''-(1,3,5-benzinetriyl)-tris(1-phenyl-1-h-benzimidazole)": "TPBi",
    "4,7-diphenyl-1,10-phenanthroline": "BPhen",
    "tris(2-phenylpyridine)iridium": "Ir(ppy)3",
    "fac-Ir(ppy)3": "Ir(ppy)3",
    "CBP": "CBP",
    "NPB": "NPB",
    "TPBi": "TPBi",
    "BPhen": "BPhen",
    "Ir(ppy)3": "Ir(ppy)3",
    "mCP": "mCP",
    "TCTA": "TCTA",
}
ALIAS_PAIRS = [
    r"\b([A-Za-z][A-Za-z0-9/\-]*(?:\s+[A-Za-z0-9/\-]+){0,5})\s*\(\s*([A-Z][A-Z0-9\-]{1,20})\s*\)",
    r"\b([A-Z][A-Z0-9\-]{1,20})\s*\(\s*([A-Za-z][A-Za-z0-9/\-]*(?:\s+[A-Za-z0-9/\-]+){0,5})\s*\)",
]
ABBREVIATION = r"^[A-Z][A-Z0-9\-]{1,20}$"

ROW_KEY_HINT = (
    r"\b(material|materials|compound|sample|name|structure|device|example)\b|材料|化合物|样品|名称|结构|器件"
)
SENTENCE_END = r"[.;。；]\s*"
ROLE_FILLER = r"^\s*(?:material|compound|is|was|:|：|=|-|\(|\)|\.)*\s*$"
ROLE_AS = r"\b(?:was\s+used\s+as|used\s+as|served\s+as|functioned\s+as|acts?\s+as|as)\b"
IN_LAYER = r"\bin\b"
CHUNK_SPLIT = r"[,，;；:：]\s*|\b(?:and|or|with|wherein)\b|以及|并且"
# Longest gaps and distance, in characters, of the role rules.
AS_GAP, FILLER_GAP, LAYER_GAP, ROLE_DISTANCE = 64, 32, 24, 40

# Office prefixes of file names, and language codes, to the language packs of a layout engine.
PREFIX_LANGUAGE = {
    "CN": "ch", "CH": "ch", "JP": "japan", "KR": "korean", "US": "en", "EP": "en", "WO": "en", "GB": "en",
    "AU": "en", "CA": "en", "TW": "chinese_cht", "DE": "latin", "FR": "latin", "ES": "latin", "IT": "latin",
    "RU": "cyrillic",
}
LANGUAGE_PACK = {
    "en": "en", "fr": "latin", "de": "latin", "es": "latin", "it": "latin", "pt": "latin",
    "ru": "cyrillic", "zh": "ch", "ja": "japan", "ko": "korean", "ar": "arabic",
}
LANGUAGE_NAMES = {
    "english": "en", "french": "fr", "german": "de", "spanish": "es", "japanese": "ja", "korean": "ko",
    "chinese": "zh", "russian": "ru", "arabic": "ar", "portuguese": "pt", "italian": "it",
}

# Words of error texts, lower case: a word of each list makes a second try without tables worth while.
TABLE_WORDS = ("table", "tablemaster", "table transformer", "rapidtable", "wired table", "table_rec", "table_enable", "表格")
ERROR_WORDS = ("error", "exception", "traceback", "runtimeerror", "assert", "failed", "cuda", "cublas", "oom", "崩溃", "失败")
DONE_STATES = ("done", "done_without_tables")
PAGES_PER_PART = 60
