"""Model names: which known model of its make a free text means, from an index of the models' words."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.canon import lookup
from lotwise.functions.text import fold, jaccard, squeeze
from lotwise.session import settled, spread

MERCEDES = "MERCEDES BENZ"

# Makes under other names, as patterns over upper case without accents.
MAKES = (
    (r"\bMERCEDES[- ]?BENZ\b", MERCEDES),
    (r"\bMERCEDES\b(?!\s*BENZ)", MERCEDES),
    (r"\bB\.?M\.?W\b", "BMW"),
    (r"\bV[WN]\b", "VOLKSWAGEN"),
    (r"\bALFA\s+ROMEO\b", "ALFA ROMEO"),
    (r"\bDS\s+AUTOMOBILES\b", "DS"),
    (r"\bDR\s+AUTOMOBILES\b", "DR"),
)
# Words that name no model, and makes that keep some of them or drop more.
NOISE = (
    "4X4", "AWD", "FWD", "RWD", "XDRIVE", "QUATTRO", "4MATIC", "AUTOMATIC", "AUTO", "BVA", "EAT", "MANUAL", "HYBRID", "PHEV", "ELECTRIC", "DIESEL", "GASOLINA", "PETROL", "SPORT", "AMG", "GTI", "ST", "RS",
    "GRAND", "GRAN", "BUSINESS", "LIFE", "LOUNGE", "CHIC", "TOURER", "ACTIVE", "XLINE", "URBAN", "CROSSBACK", "CROSS", "STEPWAY", "COUPE",
)
KEPT = {MERCEDES: ("COUPE",), "MINI": ("ELECTRIC",)}
DROPPED = {MERCEDES: ("CLASE", "CLASSE", "CLASS")}
# Words that are makes.
MAKE_WORDS = (
    "ABARTH", "ALFA", "ROMEO", "ASTON", "MARTIN", "AUDI", "BMW", "BYD", "CITROEN", "CUPRA", "DACIA", "DS", "FERRARI", "FIAT", "FORD", "HONDA", "HYUNDAI", "INFINITI", "JAGUAR", "JEEP", "KIA", "LADA", "LANCIA", "LAND", "ROVER",
    "LEXUS", "MERCEDES", "BENZ", "MG", "MINI", "MITSUBISHI", "NISSAN", "OPEL", "PEUGEOT", "PORSCHE", "RENAULT", "ROLLS", "ROYCE", "SEAT", "SKODA", "SMART", "SSANGYONG", "SUBARU", "SUZUKI", "TESLA", "TOYOTA", "VOLKSWAGEN", "VW", "VOLVO",
)
# Words of a model that its text needn't hold.
UNSAID = ("MERCEDES", "BENZ", "CLASE", "CLASSE", "CLASS")
# What a word counts by its place in the text, and beyond.
PLACES, BEYOND = (1.0, 0.85, 0.7, 0.55, 0.4, 0.3), 0.2
# Weights of the features, and those of makes that differ.
WEIGHTS = {"recall": 0.45, "pref": 0.20, "length": 0.05, "subset": 0.10, "digits": 0.05, "guard": 0.10, "v2flag": 0.15, "family": 0.10, "lex": 0.10, "first_token": 0.20, "pref_pos": 0.15, "present": 0.25, "coupe": 0.0}
MAKE_WEIGHTS = {
    "BMW": {"v2flag": 0.22, "subset": 0.15, "digits": 0.08, "recall": 0.4, "pref": 0.2},
    MERCEDES: {"guard": 0.18, "family": 0.12, "coupe": 0.35, "first_token": 0.25},
    "VOLKSWAGEN": {"v2flag": 0.18, "lex": 0.12},
    "MAZDA": {"family": 0.14},
    "MINI": {"guard": 0.12},
}


@dataclass(frozen=True)
class Rule:
    """In texts of a make that hold the pattern (and ``also``, and not ``unless``), the target; $1 stands for the first group.

    With ``each`` the pattern is held against each word, and the words that have it are the targets.
    """

    make: str
    pattern: str
    target: str = ""
    also: str = ""
    unless: str = ""
    each: bool = False


_BMW = (Rule("BMW", r"\bIX\s*([1-7])\b", "IX$1"), Rule("BMW", r"\bIX\b", "IX"), Rule("BMW", r"\bX\s*([1-7])\b", "X$1"), Rule("BMW", r"\bZ\s*([1-8])\b", "Z$1"))
_VOLVO = (Rule("VOLVO", r"\b(V|S|XC)\s*-?\s*(\d{2})\b", "$1$2"),)
_MAZDA = tuple(Rule("MAZDA", rf"\bMAZDA\s*{d}\b", d, unless=rf"\b(CX|MX)\s*-?\s*{d}\b") for d in "2536")
# The patterns that decide at once, in this order.
HARD = (
    Rule(MERCEDES, r"\bMARCO\s+POLO\b", "MARCO POLO"),
    Rule("LAND ROVER", r"\bD350\b", "DEFENDER"),
    Rule("MG", r"\bEHS\b", "HS"),
    *_BMW, *_VOLVO, *_MAZDA,
    Rule("VOLKSWAGEN", r"\bID\s*[.\-]?([3457])\b", "ID $1"),
    Rule(MERCEDES, r"^([ABCES])[-\s]?\d{2,3}", "CLASE $1 COUPE", also=r"\bCOUPE\b"),
    Rule(MERCEDES, r"^([ABCES])[-\s]?\d{2,3}", "CLASE $1"),
)
# The patterns that speak for a model and against the others.
GUARDS = (
    *_BMW,
    Rule(MERCEDES, r"\bGLC\b.*\bCOUPE\b", "GLC COUPE"),
    *(Rule(MERCEDES, rf"\b{m}\b", m) for m in ("GLA", "GLB", "GLC", "GLE", "GLS")),
    *_VOLVO, *_MAZDA,
    Rule("DS", r"\bDS[- ]?([3457])\b", "DS $1"),
    Rule("DS", r"\bDS[- ]?([3457])\b", "DS$1"),
    Rule("DR", r"\bDR[\s\-]?(\d)[.,](\d)\b", "DR $1 $2"),
    Rule("DR", r"\bDR[\s\-]?(\d)\b(?![.,]\d)", "DR $1"),
    Rule("NISSAN", r"\bX[- ]?TRAIL\b", "X-TRAIL"),
    Rule("KIA", r"\bPRO[\s_]?CEE[’'`´]?D\b", "PROCEED"),
    Rule("SMART", "FORTWO", "FORTWO"),
    Rule("SMART", "FORFOUR", "FORFOUR"),
    Rule("HONDA", r"\bCR[- ]?Z\b", "CR-Z"),
    Rule("HONDA", r"\bHR[- ]?V\b", "HR-V"),
    Rule("HYUNDAI", r"\bH[- ]?1\b", "H-1"),
    Rule("FORD", r"\bB[- ]?MAX\b", "B-MAX"),
    Rule("CITROEN", r"\bC[- ]?E?LYSEE\b|\bCELYSEE\b", "C-ELYSEE"),
    Rule("ALFA ROMEO", "TONALE", "TONALE"),
)
# The family that a text hints at.
FAMILIES = (
    Rule("BMW", r"\b([1-8])\d{2}[A-Z]?\b", "SERIE $1"),
    *(Rule(MERCEDES, rf"^(?:(?:MERCEDES|BENZ)\s+)*{c}\b", f"CLASE {c}") for c in ("A", "B", "C", "E", "S", "CLS")),
    *(Rule(MERCEDES, rf"^(?:(?:MERCEDES|BENZ)\s+)*{c}\b", c) for c in ("CLA", "GLA", "GLB", "GLC", "GLE", "GLS")),
    Rule("VOLKSWAGEN", r"\bID\s*[.\-]?([3457])\b", "ID $1"),
    Rule("MAZDA", r"\b(CX|MX)\s*-?\s*(\d{1,2})\b", "$1-$2"),
    Rule("MAZDA", r"\bMAZDA\s*([2356])\b", "$1"),
    Rule("DS", r"\bDS[\s\-]?([3457])\b", "DS $1"),
    Rule("DR", r"\bDR[\s\-]?(\d)[.,](\d)\b", "DR $1 $2"),
    Rule("DR", r"\bDR[\s\-]?(\d)\b(?![.,]\d)", "DR $1"),
)
# Texts that narrow the models of their make to those with a word, where there are any; the first pattern counts.
POOLS = (
    Rule(MERCEDES, "COUPE", "COUPE"),
    Rule("MINI", r"\bPACEMAN\b", "PACEMAN"),
    Rule("MINI", r"\bCOUNTR?YMAN\b", "COUNTRYMAN"),
    Rule("MINI", r"\bCLUBMAN\b", "CLUBMAN"),
    Rule("MINI", r"\b(ELECTRIC|SE|COOPER\s*SE|E[-\s]?MINI)\b", "MINI ELECTRIC"),
)
# The decisions of the scorer by points, in its own spelling of texts.
POINT_RULES = (
    Rule(MERCEDES, r"\b([ABCESG])\s?\d{2,3}\b", "CLASE $1"),
    Rule("BMW", r"\b([1-8])\d{2}[A-Z]?\b", "SERIE $1"),
    *(Rule("BMW", rf"\b{m}\b", m) for m in ("I3", "I4", "I5", "I7", "IX", "IX1", "IX2", "IX3")),
    Rule("PEUGEOT", r"^\d+$", each=True),
    Rule("FIAT", r"^500$", each=True),
    *(Rule(MERCEDES, rf"\bE\b.*\b{m}\b|\b{m}\b.*\bE\b", f"E {m}") for m in ("VITO", "SPRINTER", "CITAN")),
    *(Rule(MERCEDES, rf"\bE\b.*\b{m}\b|\b{m}\b.*\bE\b|\bE{m}\b", m) for m in ("VITO", "SPRINTER", "CITAN")),
)
POINT_NOISE = ("AUTOMOBILES", "EDITION", "BUSINESS", "PACK", "LINE", "SPORT", "SPORTS", "AUTOTRONIC", "AUTOMATIC", "S&S", "MY20", "CV", "CVS", "CVV", "HP", "PS", "DIESEL", "BENZINA", "GASOLINA", "PETROL", "HYBRID", "ELECTRIC", "ELEKTROMOTOR", "LANG")
POINT_NOISE_OF = {
    "BMW": ("XDRIVE", "STEPTRONIC", "AUT", "AUTOMATIC", "DCT", "TOURING", "GRAN", "COUPE", "PACK", "LINE", "MHEV"),
    MERCEDES: ("4MATIC", "9G", "9GTRONIC", "TRONIC", "BLUETEC", "BLUEEFFICIENCY", "KOMBI", "KOMPAKT", "TOURER", "AMG"),
}
# Names that are shown in another spelling.
SHOWN = {
    "AUDI": {"E-TRON": "E TRON"},
    "DS": {"DS3": "DS 3", "DS4": "DS 4", "DS5": "DS 5", "DS7": "DS 7", "DS-3": "DS 3", "DS-4": "DS 4", "DS-5": "DS 5", "DS-7": "DS 7"},
    "MITSUBISHI": {"L-200": "L200"},
    "NISSAN": {"370-Z": "370Z", "GT-R": "GTR"},
    "TOYOTA": {"GT-86": "GT86"},
    "FIAT": {"500 E": "500E"},
    MERCEDES: {
        "EVITO": "VITO", "E-VITO": "VITO", "E VITO": "VITO", "ESPRINTER": "SPRINTER", "E-SPRINTER": "SPRINTER", "E SPRINTER": "SPRINTER", "ECITAN": "CITAN", "E-CITAN": "CITAN", "E CITAN": "CITAN",
        "CLASE CLA": "CLA", "CLASE CLS": "CLS", "CLASE SLK": "SLK", "CLASE SL": "SL", "CLASE SLC": "SLC", "CLASE CLK": "CLK", "CLASE GLK": "GLK", "CLASE GL": "GL", "CLASE CLA COUPE": "CLA COUPE", "CLASE CLS COUPE": "CLS COUPE",
    },
    "VOLKSWAGEN": {
        "T ROC": "T-ROC", "TROC": "T-ROC", "T CROSS": "T-CROSS", "TCROSS": "T-CROSS", "T-CROS": "T-CROSS", "ID BUZZ": "ID. BUZZ",
        "ID 3": "ID.3", "ID3": "ID.3", "ID-3": "ID.3", "ID 4": "ID.4", "ID4": "ID.4", "ID-4": "ID.4", "ID 5": "ID.5", "ID5": "ID.5", "ID-5": "ID.5", "ID 7": "ID.7", "ID7": "ID.7", "ID-7": "ID.7",
    },
    "MAZDA": {"MX 5": "MX-5", "CX 5": "CX-5", "CX 30": "CX-30", "MX 30": "MX-30", "CX 60": "CX-60"},
    "MG": {"EHS": "HS"},
    "DR": {"DR3": "DR 3", "DR4": "DR 4", "DR5": "DR 5"},
}
#: Models of a make up to which a word is rare.
RARE = 16


@dataclass(frozen=True)
class Knowledge:
    """What is known of makes beside their models; all of it can be given."""

    hard: tuple[Rule, ...] = HARD
    guards: tuple[Rule, ...] = GUARDS
    families: tuple[Rule, ...] = FAMILIES
    pools: tuple[Rule, ...] = POOLS
    points: tuple[Rule, ...] = POINT_RULES
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    make_weights: dict[str, dict[str, float]] = field(default_factory=lambda: {k: dict(v) for k, v in MAKE_WEIGHTS.items()})
    #: Makes whose models must have all their words in the text.
    strict: tuple[str, ...] = (MERCEDES,)


# --- texts ----------------------------------------------------------------------------------------------------------


def brand(c: Column) -> Column:
    """Upper case without accents, under the make's usual name; empty for null."""
    out = F.trim(fold(F.upper(F.coalesce(c, F.lit("")))))
    for pattern, name in MAKES:
        out = F.regexp_replace(out, pattern, name)
    return out


def spelled(c: Column) -> Column:
    """Upper case without accents; underscores and dots part words, other marks stay."""
    return squeeze(F.regexp_replace(fold(F.upper(F.coalesce(c, F.lit("")))), "[_.]+", " "))


def words(c: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "), r"\s+"), "")


def pointed(c: Column) -> Column:
    """The spelling of the scorer by points: marks and dashes part words, ID and its number stand together."""
    out = F.regexp_replace(F.trim(fold(F.upper(F.coalesce(c, F.lit(""))))), "[/_,.;:]+", " ")
    return squeeze(F.replace(F.regexp_replace(out, r"\bID[\s\-]?(\d)\b", "ID.$1"), F.lit("-"), F.lit(" ")))


def choose_text(model: Column, submodel: Column, make: Column) -> Column:
    """Of Mercedes the sub-model first, where it is filled; else the model."""
    sub = F.nullif(F.trim(submodel), F.lit(""))
    return F.when(brand(make) == MERCEDES, F.coalesce(sub, model)).otherwise(model)


def _among(c: Column, values: tuple[str, ...]) -> Column:
    return c.isin(*values) if values else F.lit(False)


def told(c: Column, make: Column) -> Column:
    """Words of a text that may name its model: all but noise, or all where nothing else is left."""
    own = words(c)

    def noise(w: Column) -> Column:
        out = _among(w, NOISE)
        for b, kept in KEPT.items():
            out = out & ~((make == b) & _among(w, kept))
        for b, dropped in DROPPED.items():
            out = out | ((make == b) & _among(w, dropped))
        return out

    left = F.filter(own, lambda w: ~noise(w))
    return F.when(F.size(left) > 0, left).otherwise(own)


def _like(pattern: str):
    return lambda w: w.rlike(pattern)


def targets(rules: tuple[Rule, ...], make: Column, text: Column) -> Column:
    """The targets of the rules that hold for a text, in order; only the rules of its make are tried."""
    out = None
    for b in dict.fromkeys(r.make for r in rules):
        found = []
        for r in rules:
            if r.make != b:
                continue
            if r.each:
                found.append(F.filter(F.split(text, " "), _like(r.pattern)))
                continue
            hit = text.rlike(r.pattern)
            hit = hit & text.rlike(r.also) if r.also else hit
            hit = hit & ~text.rlike(r.unless) if r.unless else hit
            named = F.regexp_replace(F.regexp_extract(text, r.pattern, 0), r.pattern, r.target) if "$" in r.target else F.lit(r.target)
            found.append(F.array(F.when(hit, named)))
        each = F.array_compact(F.concat(*found))
        out = F.when(make == b, each) if out is None else out.when(make == b, each)
    return (out.otherwise(F.array().cast("array<string>")) if out is not None else F.array().cast("array<string>"))


def related(a: Column, b: Column) -> Column:
    return F.startswith(a, b) | F.startswith(b, a)


def first_own(tokens: Column, make: Column) -> Column:
    """The first word that isn't of a make."""
    return F.get(F.filter(tokens, lambda w: ~_among(w, MAKE_WORDS) & ~F.array_contains(F.split(make, " "), w)), F.lit(0))


def unsaid(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: ~_among(w, UNSAID))


def prefixes(w: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(w)), lambda n: F.substring(w, F.lit(1), n))


# --- known models and their index -----------------------------------------------------------------------------------


def known(whitelist: DataFrame) -> DataFrame:
    """(b, cand, points, shown, ct): one row for each make and spelled model; without its words a model is unknown."""
    shown = F.nullif(F.trim(F.col("DISPLAY")), F.lit("")) if "DISPLAY" in whitelist.columns else F.lit(None).cast("string")
    whitelist = spread(whitelist.select("MARCA", "MODELO", *["DISPLAY"] * ("DISPLAY" in whitelist.columns)).distinct())
    rows = whitelist.select(brand(F.col("MARCA")).alias("b"), spelled(F.col("MODELO")).alias("cand"), pointed(F.col("MODELO")).alias("points"), F.coalesce(shown, F.upper(F.trim("MODELO"))).alias("shown"))
    rows = rows.where("b <> ''").groupBy("b", "cand").agg(F.min("points").alias("points"), F.min("shown").alias("shown"))
    other = lookup(F.concat_ws("|", "b", F.upper("shown")), {f"{b}|{k}": v for b, names in SHOWN.items() for k, v in names.items()}, F.col("shown"))
    return rows.withColumn("shown", other).withColumn("ct", words(F.col("cand"))).where(F.size("ct") > 0)


def families(models: DataFrame) -> DataFrame:
    """(b, cand, root): of the models whose words a model begins with, the shortest; itself if there is none.

    Models meet their ancestors by an equi-join on their own word prefixes.
    """
    line = F.transform(F.sequence(F.lit(1), F.size("ct")), lambda n: F.array_join(F.slice("ct", 1, n), " "))
    begun = models.select("b", "cand", F.explode(line).alias("head"))
    heads = models.select("b", F.array_join("ct", " ").alias("head"), F.col("cand").alias("root")).groupBy("b", "head").agg(F.min("root").alias("root"))
    return begun.join(heads, ["b", "head"]).groupBy("b", "cand").agg(F.min_by("root", F.struct(F.length("head"), "root")).alias("root"))


def _kind(pools: tuple[Rule, ...]) -> list[Column]:
    """What features and pools see of a model besides its words and its length."""
    holds = F.array(*(F.contains("cand", F.lit(r.target)) for r in pools)) if pools else F.array().cast("array<boolean>")
    return [F.col("cand").rlike(r"\p{Nd}"), F.contains("cand", F.lit("COUPE")), holds]


def index(models: DataFrame, pools: tuple[Rule, ...], rare: int) -> tuple[DataFrame, DataFrame]:
    """(words of the models with their number, (b, key, cand)): under which keys a text meets a model.

    A word of at most ``rare`` models of its make leads to all of them. A model that a text shares only one
    frequent word with is like all others with that word, the same number of words and the same kind,
    but for its length: the two shortest stand for them. With two frequent words it is found under
    their pair. Two models of each kind stand for those that share nothing. So no text meets a whole make,
    and the two best of all models are always among those it meets.
    """
    each = models.select("b", "cand", "ct", F.explode(F.array_distinct("ct")).alias("word"))
    vocabulary = each.groupBy("b", "word").agg(F.count(F.lit(1)).alias("n"))
    each = each.join(vocabulary, ["b", "word"])
    one = each.where(F.col("n") <= rare).select("b", F.concat(F.lit("1 "), "word").alias("key"), "cand")
    often = each.where(F.col("n") > rare)
    like = Window.partitionBy("b", "word", F.size("ct"), F.size(unsaid(F.col("ct"))), first_own(F.col("ct"), F.col("b")) == F.col("word"), F.array_contains(unsaid(F.col("ct")), F.col("word")), F.size(F.array_distinct("ct")), F.size(F.filter("ct", lambda w: w == F.col("word"))), *_kind(pools))
    shortest = [F.length("cand"), F.col("cand")]
    alike = often.withColumn("i", F.row_number().over(like.orderBy(*shortest))).where("i <= 2").select("b", F.concat(F.lit("2 "), "word").alias("key"), "cand")
    sets = often.groupBy("b", "cand").agg(F.array_sort(F.collect_set("word")).alias("w")).where(F.size("w") > 1)
    two = sets.select("b", F.explode(_pairs("w")).alias("key"), "cand")
    plain = models.withColumn("i", F.row_number().over(Window.partitionBy("b", *_kind(pools)).orderBy(*shortest))).where("i <= 2").select("b", F.lit("4").alias("key"), "cand")
    name = models.select("b", F.concat(F.lit("5 "), "cand").alias("key"), "cand")
    return vocabulary, one.unionByName(alike).unionByName(two).unionByName(plain).unionByName(name)


def _pairs(array: str) -> Column:
    """Keys of the pairs of a sorted array."""
    return F.flatten(F.transform(array, lambda x, i: F.transform(F.slice(array, i + 2, F.size(array)), lambda y: F.concat(F.lit("3 "), x, F.lit(" "), y))))


def met(texts: DataFrame, vocabulary: DataFrame, rare: int) -> DataFrame:
    """(b, t, key) of each text by its words ``tt``: a word and one of a model meet if one begins with the other."""
    terms = texts.select("b", F.explode("tt").alias("term")).distinct()
    longer = terms.select("b", "term", F.explode(prefixes(F.col("term"))).alias("word")).join(vocabulary, ["b", "word"])
    shorter = vocabulary.select("b", "word", "n", F.explode(prefixes(F.col("word"))).alias("term")).join(terms, ["b", "term"])
    pairs = longer.select("b", "term", "word", "n").unionByName(shorter.select("b", "term", "word", "n")).distinct()
    hits = texts.select("b", "t", F.explode(F.array_distinct("tt")).alias("term")).join(pairs, ["b", "term"]).select("b", "t", "word", "n").distinct()
    single = hits.select("b", "t", F.concat(F.when(F.col("n") <= rare, "1 ").otherwise("2 "), "word").alias("key"))
    double = hits.where(F.col("n") > rare).groupBy("b", "t").agg(F.array_sort(F.collect_set("word")).alias("w")).select("b", "t", F.explode(_pairs("w")).alias("key"))
    return single.unionByName(double)


# --- the scorer by points -------------------------------------------------------------------------------------------


def by_points(texts: DataFrame, models: DataFrame, rules: tuple[Rule, ...] = POINT_RULES, least: int = 50) -> DataFrame:
    """(b, t, pick, points_score): the model with the most points, at least ``least``; a rule with a known target decides.

    Texts: b, t and p, the text in the spelling of ``pointed``. 100 for the same text, 60 if the text holds the model, 40 if it has its words,
    half the length up to 20, 15 for numbers in both, 10 less for noise in the model. Fewer than ``least`` = 50 can
    only be reached by a model whose words or whose text are in the text: a text meets the models
    that begin with three of its letters in a row, or have one of its words first in their order.
    """
    gram = F.substring("points", 1, 3)
    cards = models.select("b", "cand", "points", F.split("points", " ").alias("pc")).where("points <> ''")
    first = F.array_min("pc")
    keys = cards.select("b", "cand", "points", "pc", F.explode(F.array_distinct(F.array(F.concat(F.lit("g "), gram), F.concat(F.lit("w "), first)))).alias("key"))
    own = texts.where("p <> ''").withColumn("pt", F.split("p", " ")).withColumn("rules", targets(rules, F.col("b"), F.col("p")))
    starts = F.flatten(F.transform(F.sequence(F.lit(1), F.length("p")), lambda i: F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.substring(F.col("p"), i, n))))
    keyed = own.select("b", "t", "p", "pt", F.explode(F.array_distinct(F.concat(F.transform(starts, lambda g: F.concat(F.lit("g "), g)), F.transform("pt", lambda w: F.concat(F.lit("w "), w))))).alias("key"))
    pairs = keyed.join(keys, ["b", "key"])

    def noisy(w: Column) -> Column:
        out = _among(w, POINT_NOISE)
        for b, more in POINT_NOISE_OF.items():
            out = out | ((F.col("b") == b) & _among(w, more))
        return out

    holds = F.contains("p", F.col("points"))
    subset = F.size(F.array_except("pc", F.filter("pt", lambda w: ~noisy(w)))) == 0
    pairs = pairs.where(holds | subset).select("b", "t", "p", "pt", "cand", "points", "pc", holds.alias("holds"), subset.alias("subset")).distinct()
    digit = r"\p{Nd}"
    score = F.when(F.col("p") == F.col("points"), 100).otherwise(0) + F.when(F.col("holds"), 60).otherwise(0) + F.when(F.col("subset"), 40).otherwise(0)
    score = score + F.floor(F.least(F.length("points"), F.lit(40)) / 2).cast("int") + F.when(F.col("points").rlike(digit) & F.col("p").rlike(digit), 15).otherwise(0)
    score = score - F.when(F.exists("pc", noisy), 10).otherwise(0)
    # Of Mercedes a number is no model and a trim none either; a class stands back behind the short name that is a model, too.
    short = cards.select("b", F.concat(F.lit("CLASE "), "points").alias("points"), F.lit(5).alias("behind")).where(F.col("b") == MERCEDES).distinct()
    special = F.when(F.col("b") == MERCEDES, F.when(F.col("points").rlike("^[0-9]+$"), 100).otherwise(0) + F.when(F.col("points") == "AMG", 500).otherwise(0)).otherwise(0)
    scored = pairs.join(short, ["b", "points"], "left").withColumn("score", score - special - F.coalesce("behind", F.lit(0)))
    best = scored.groupBy("b", "t").agg(F.min_by(F.struct("cand", "score"), F.struct(-F.col("score"), "points", "cand")).alias("best"))
    ruled = own.select("b", "t", F.posexplode("rules").alias("i", "points")).join(cards.select("b", "points", "cand"), ["b", "points"]).groupBy("b", "t").agg(F.min_by("cand", F.struct("i", "cand")).alias("ruled"))
    both = texts.select("b", "t").join(best, ["b", "t"], "left").join(ruled, ["b", "t"], "left")
    enough = F.when(F.col("best.score") >= least, F.col("best.cand"))
    return both.select("b", "t", F.coalesce("ruled", enough).alias("pick"), F.when(F.col("ruled").isNull(), F.col("best.score")).alias("points_score"))


# --- fusion ---------------------------------------------------------------------------------------------------------


def features(strict: tuple[str, ...]) -> dict[str, Column]:
    """The features of a pair of a text (t, tt) and a model (cand, ct), given guard, pick and family."""
    tt, ct, b = F.col("tt"), F.col("ct"), F.col("b")
    hits = F.size(F.filter(ct, lambda c: F.exists(tt, lambda x: related(x, c))))
    ti, tc = first_own(tt, b), first_own(ct, b)
    said = unsaid(ct)
    loose = F.forall(said, lambda c: F.when(c.rlike(r"^\p{L}+$"), F.array_contains(tt, c)).otherwise(F.exists(tt, lambda x: related(x, c))))
    present = (F.size(said) > 0) & F.when(_among(b, strict), loose).otherwise(F.size(F.array_except(said, tt)) == 0)
    place = F.filter(F.transform(said, lambda c: F.array_position(F.transform(tt, lambda x: related(x, c)), True)), lambda p: p > 0)
    worth = F.transform(place, lambda p: F.when(p > len(PLACES), BEYOND).otherwise(F.get(F.array(*map(F.lit, PLACES)), (p - 1).cast("int"))))
    digit = r"\p{Nd}"
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return {
        "recall": hits / F.size(ct).cast("double"),
        "pref": flag(related(ti, tc)),
        "length": 1.0 / (1.0 + 0.15 * F.length("cand")),
        "subset": flag(F.size(F.array_except(ct, tt)) == 0),
        "digits": flag(F.array_join(ct, "").rlike(digit) & F.array_join(tt, "").rlike(digit)),
        "guard": F.when(F.col("guard").isNull(), 0.0).when(F.col("guard") == F.col("cand"), 1.0).otherwise(-0.2),
        "v2flag": flag(F.col("pick") == F.col("cand")),
        "family": flag(F.contains("cand", F.col("family"))),
        "lex": jaccard(tt, ct),
        "first_token": flag(ti == tc),
        "pref_pos": F.when(F.size(worth) > 0, F.aggregate(worth, F.lit(0.0), lambda a, x: a + x) / F.size(worth)).otherwise(0.0),
        "present": flag(present),
        "coupe": F.when(~F.contains("t", F.lit("COUPE")), 0.0).when(F.contains("cand", F.lit("COUPE")), 1.0).otherwise(-1.0),
    }


def candidates(df: DataFrame, brand_col: str, model_col: str, models: DataFrame, what: Knowledge = Knowledge(), rare: int = RARE) -> DataFrame:
    """All models that the distinct texts meet, with the thirteen features, score and rank; hard decisions are marked.

    Models are those of ``known``. Columns: b, key (the text), cand, shown, pick, guard, the features, score, hard, rank (1 is the best, ties in the order
    of names). The distinct texts and the picks by points are settled, as several joins read them.
    """
    b, text = brand(F.col(brand_col)), spelled(F.col(model_col))
    text = F.when(b == MERCEDES, F.regexp_replace(text, r"\bE[- ]?(VITO|SPRINTER|CITAN)\b", "$1")).otherwise(text)
    # Texts that are told apart by noise alone are one; the scorer by points reads the first of their spellings.
    texts = spread(df.select(brand_col, model_col).distinct()).select(b.alias("b"), text.alias("u"), pointed(F.col(model_col)).alias("p")).where("b <> ''").withColumn("tt", told(F.col("u"), F.col("b"))).where(F.size("tt") > 0)
    texts = spread(texts.select("b", F.concat_ws(" ", "tt").alias("t"), "tt", "p").distinct())
    texts = texts.withColumn("t2", F.concat_ws("\n", "t", "p")).withColumns({
        "hards": targets(what.hard, F.col("b"), F.col("t")), "guards": targets(what.guards, F.col("b"), F.col("t")), "family": F.get(targets(what.families, F.col("b"), F.col("t")), F.lit(0)), "pool": F.get(targets(what.pools, F.col("b"), F.col("t")), F.lit(0)),
    })
    alone = settled(texts.select("b", F.col("t2").alias("t"), "tt", "p", "hards", "guards", "family", "pool"))
    vocabulary, keys = index(models, what.pools, rare)
    picks = settled(by_points(alone.select("b", "t", "p"), models, what.points).select("b", "t", "pick").where("pick is not null"))
    named = F.transform(F.concat("hards", "guards"), lambda c: F.concat(F.lit("5 "), c))
    asked = met(alone.select("b", "t", "tt"), vocabulary, rare).unionByName(alone.select("b", "t", F.explode(F.array_append(named, F.lit("4"))).alias("key"))).unionByName(picks.select("b", "t", F.concat(F.lit("5 "), "pick").alias("key")))
    found = asked.join(keys, ["b", "key"]).select("b", "t", "cand")
    hinted = alone.where("family is not null").select("b", "family").distinct().join(models.select("b", "cand"), "b").where(F.contains("cand", F.col("family")))
    found = found.unionByName(alone.join(hinted, ["b", "family"]).select("b", "t", "cand")).distinct()
    pairs = found.join(alone, ["b", "t"]).join(picks, ["b", "t"], "left").join(models.select("b", "cand", "shown", "ct"), ["b", "cand"])
    pairs = pairs.withColumn("key", F.col("t")).withColumn("t", F.concat_ws(" ", "tt"))
    group = Window.partitionBy("b", "key")
    place = lambda name: F.min(F.when(F.array_position(name, F.col("cand")) > 0, F.array_position(name, F.col("cand")))).over(group)
    pairs = pairs.withColumn("hard_at", place("hards"))
    # The pool: models of strict makes that are all there; then those with the text's word, where there are any.
    open_ = ~_among(F.col("b"), what.strict) | (features(what.strict)["present"] == 1.0)
    pairs = pairs.withColumn("open", open_)
    narrow = F.contains("cand", F.col("pool"))
    pairs = pairs.withColumn("narrowed", F.max(F.col("open") & F.coalesce(narrow, F.lit(False))).over(group))
    pairs = pairs.withColumn("open", F.col("open") & (~F.col("narrowed") | F.coalesce(narrow, F.lit(False))))
    is_hard = F.coalesce(F.get("hards", (F.col("hard_at") - 1).cast("int")) == F.col("cand"), F.lit(False))
    pairs = pairs.withColumn("hard", is_hard).where((F.col("hard_at").isNotNull() & F.col("hard")) | (F.col("hard_at").isNull() & F.col("open")))
    guard_at = place("guards")
    pairs = pairs.withColumn("guard", F.get("guards", (guard_at - 1).cast("int")))
    values = features(what.strict)
    score = F.lit(0.0)
    for name, weight in what.weights.items():
        own = {m: float(w[name]) for m, w in what.make_weights.items() if name in w}
        score = score + values[name] * (lookup(F.col("b"), own, F.lit(float(weight))) if own else F.lit(float(weight)))
    scored = pairs.withColumns({f"f_{k}": v for k, v in values.items()}).withColumn("score", F.round(score, 9))
    return scored.withColumn("rank", F.row_number().over(group.orderBy(F.desc("score"), "cand"))).select("b", "key", "cand", "shown", "pick", "guard", *(f"f_{k}" for k in values), "score", "hard", "rank")


def fused(df: DataFrame, key: str, brand_col: str, model_col: str, whitelist: DataFrame, what: Knowledge = Knowledge(), rare: int = RARE) -> DataFrame:
    """(key, make, model, second, confidence, family) of each row: the known model that its text means.

    Whitelist: MARCA, MODELO, optionally DISPLAY. A hard rule decides with confidence 1 and no second; else the
    score of thirteen features does, and the confidence is its lead over the second (0 without one
    counts as the second's score). Rows without a make, a word or a model to choose get null and
    confidence 0. ``family`` is the shortest known model that the found one begins with. Equal
    texts are decided once; null keys and repeated rows stay.
    """
    models = settled(spread(known(whitelist)))
    # Rows that are written alike are read once.
    written = settled(df.select(F.col(brand_col).alias("make_text"), F.col(model_col).alias("model_text")).distinct())
    ranked = candidates(written.select(F.col("make_text").alias(brand_col), F.col("model_text").alias(model_col)), brand_col, model_col, models, what, rare).where("rank <= 2")
    top = ranked.groupBy("b", "key").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("cand", "shown", "score", "hard"))).alias("one"), F.max(F.when(F.col("rank") == 2, F.struct("shown", "score"))).alias("two")
    )
    top = top.select("b", "key", F.col("one.cand").alias("cand"), F.col("one.shown").alias("model"), F.col("two.shown").alias("second"), F.when(F.col("one.hard"), 1.0).otherwise(F.greatest(F.lit(0.0), F.col("one.score") - F.coalesce("two.score", F.lit(0.0)))).alias("confidence"))
    top = top.join(families(models).select("b", "cand", F.col("root").alias("family")), ["b", "cand"], "left")
    b, text = brand(F.col(brand_col)), spelled(F.col(model_col))
    text = F.when(b == MERCEDES, F.regexp_replace(text, r"\bE[- ]?(VITO|SPRINTER|CITAN)\b", "$1")).otherwise(text)
    keys = spread(written).withColumns({brand_col: F.col("make_text"), model_col: F.col("model_text")}).select("make_text", "model_text", b.alias("b"), F.concat_ws("\n", F.concat_ws(" ", told(text, b)), pointed(F.col(model_col))).alias("key"))
    decided = keys.join(top, ["b", "key"], "left").select("make_text", "model_text", F.nullif("b", F.lit("")).alias("make"), "model", "second", F.round(F.coalesce("confidence", F.lit(0.0)), 6).alias("confidence"), "family")
    rows = df.select(F.col(key).alias("id"), F.col(brand_col).alias("own_make"), F.col(model_col).alias("own_model"))
    same = F.col("own_make").eqNullSafe(F.col("make_text")) & F.col("own_model").eqNullSafe(F.col("model_text"))
    return rows.join(decided, same, "left").select(F.col("id").alias(key), "make", "model", "second", "confidence", "family")
