"""Scripts and scenes as tables of lines: masked code, rule violations by folder, and every single-line fault.

A text is cut into tokens (strings, comments, what lies between) by one pattern, and tokens that aren't code are blanked, so no
reader walks its characters; rules and faults are tables of patterns compiled into columns over the lines.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.corpus import bound

#: Strings (three quotes may span lines, others end with the line), comments, and runs without either. Loops keep what they took
#: (``*+``): none ever needs to give it back, and loops that can would use stack for each character.
TOKEN = r'''"""(?:[^\\"]++|\\[\s\S]|"(?!""))*+(?:"""|\\?\z)|\'\'\'(?:[^\\\']++|\\[\s\S]|\'(?!\'\'))*+(?:\'\'\'|\\?\z)|"(?:[^"\\\n]++|\\[^\n])*+(?:"|\\?(?=\n|\z))|\'(?:[^\'\\\n]++|\\[^\n])*+(?:\'|\\?(?=\n|\z))|#[^\n]*|[^"'#]+'''.replace(r"\'", "'")


def masked(text: Column, blank: str = " ", strings: bool = True) -> Column:
    """The text with comments (and ``strings``) as blanks of the same length; lines stay where they are."""
    hidden = ("\"", "'", "#") if strings else ("#",)
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    # few tokens span lines; the others are as many blanks as letters
    blanked = lambda t: F.when(t.contains("\n"), F.regexp_replace(t, r"[^\n]", blank)).otherwise(F.repeat(F.lit(blank), F.length(t)))
    return F.array_join(F.transform(tokens, lambda t: F.when(F.substring(t, 1, 1).isin(*hidden), blanked(t)).otherwise(t)), "")


def code_lines(scripts: DataFrame) -> DataFrame:
    """Rows (id, path, line, text, code, said) of scripts (id, path, text): code without strings and comments, said without comments."""
    split = lambda c: F.split(c, "\n", -1)
    text = F.coalesce("text", F.lit(""))
    zipped = F.arrays_zip(split(text).alias("text"), split(masked(F.col("text"))).alias("code"), split(masked(F.col("text"), strings=False)).alias("said"))
    return scripts.select("id", "path", F.posexplode(zipped).alias("n", "x")).select("id", "path", (F.col("n") + 1).alias("line"), "x.text", "x.code", "x.said")


# Folders by what their scripts are, visual classes, and the rules of style and architecture: id, scope, the text
# that is searched (code or said), pattern, group, and the pattern that the group must fit (None: any match breaks the rule).
GAME = ("0_autoload", "1_core", "2_sequence", "3_entities", "4_ui")
LOGIC, TUNED = ("1_core", "3_entities"), ("2_sequence", "3_entities")
VISUAL = "Sprite2D|Sprite3D|AnimatedSprite2D|AnimatedSprite3D|AudioStreamPlayer|AudioStreamPlayer2D|AudioStreamPlayer3D|GPUParticles2D|GPUParticles3D|CPUParticles2D|CPUParticles3D"
SNAKE, PASCAL = r"^_?[a-z][a-z0-9_]*\z", r"^[A-Z][A-Za-z0-9]*\z"
MODIFIERS = r"^\s*(?:@\w+(?:\([^)\n]*\))?\s+)*(?:static\s+)?"
RULES = (
    ("COD-04", "script", "code", r"\byield\s*\(", 0, None),
    ("COD-04", "script", "code", r"^\s*(?:onready|export)\b", 0, None),
    ("COD-04", "script", "code", r"^\s*tool\s*\z", 0, None),
    ("COD-04", "script", "code", r"\bKinematicBody(?:2D)?\b", 0, None),
    ("COD-04", "script", "code", r"\.instance\s*\(\s*\)", 0, None),
    ("COD-04", "script", "said", r"\bconnect\s*\(\s*[\"']", 0, None),
    ("COD-02", "script", "code", MODIFIERS + r"(var|const)\s+\w+\s*=[^=]", 0, None),
    ("COD-02", "script", "code", r"(?::|->)\s*(?:Array|Dictionary)\b(?:\s*[^\[\s]|\s*\z)", 0, None),
    ("COD-02", "script", "code", r":=\s*[\[{]", 0, None),
    ("COD-01", "script", "code", r"^(?:static\s+)?func\s+(\w+)", 1, SNAKE),
    ("COD-01", "script", "code", MODIFIERS + r"var\s+(\w+)", 1, SNAKE),
    ("COD-01", "script", "code", r"^signal\s+(\w+)", 1, r"^[a-z][a-z0-9_]*\z"),
    ("COD-01", "script", "code", r"^enum\s+(\w+)", 1, PASCAL),
    ("COD-01", "script", "code", r"^class_name\s+(\w+)", 1, PASCAL),
    ("COD-01", "script", "code", r"^class\s+(\w+)", 1, r"^_?[A-Z][A-Za-z0-9]*\z"),
    ("DAT-02", "script", "code", r"^\s*class\s+\w+\s+extends\s+Resource\b", 0, None),
    ("ARC-06", "game", "said", r"[\"']/root\b", 0, None),
    ("ARC-06", "game", "said", r"(?:\bget_node(?:_or_null)?\s*\(\s*\^?|\$|\^)[\"']\.\./", 0, None),
    ("SIM-02", "game", "code", r"\bprocess(?:_physics)?_priority\s*=\s*-?\s*\d", 0, None),
    ("ARC-03", "logic", "code", rf"\b(?:{VISUAL})\b", 0, None),
    ("ARC-04", "logic", "code", r"\bInput\s*\.", 0, None),
    ("ARC-04", "logic", "code", r"^func\s+(?:_input|_unhandled_input|_unhandled_key_input)\s*\(", 0, None),
    ("SIM-01", "logic", "code", r"^func\s+_process\s*\(", 0, None),
    ("SIM-09", "logic", "code", r"(?:^|[^\w.])(?:randf|randi|randf_range|randi_range|randfn)\s*\(|\.(?:pick_random|shuffle)\s*\(", 0, None),
    ("COD-01", "scene", "text", r"^\[node name=\"([^\"]+)\"", 1, PASCAL),
    ("SIM-02", "scene", "text", r"^process(?:_physics)?_priority\s*=", 0, None),
)
CONSTANT = r"^(?:static\s+)?const\s+(\w+)[^=]*=\s*(.*)\z"
NUMBER = r"(?<![\w.])(\d+\.\d*(?:e-?\d+)?|\.\d+|\d+(?:e-?\d+)?)(?![\w.])"
PLAIN_NUMBERS = ("0", "1", "0.0", "1.0", "0.", "1.")
PRIORITY = r"\bprocess(?:_physics)?_priority\s*=\s*-?\s*\d"
#: What brackets hold, up to four deep.
INSIDE = r"(?:[^()]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))*"


#: Letters and digits of patterns are those of all scripts, not ASCII's.
ALL_LETTERS = "(?U)"


def scopes() -> dict[str, Column]:
    """Where a rule holds, by the path."""
    folder, path = F.split("path", "/")[0], F.col("path")
    shown = path.endswith("_view.gd") | path.contains("/effects/")
    apart, script = shown | path.endswith("_input.gd"), path.endswith(".gd")
    return {
        "script": script, "scene": path.endswith(".tscn"), "game": script & folder.isin(*GAME),
        "logic": script & folder.isin(*LOGIC) & ~apart, "tuned": script & folder.isin(*TUNED) & ~apart,
    }


def flat(c: Column) -> Column:
    """Arguments without what their brackets hold, so that commas part arguments."""
    for _ in range(4):
        c = F.regexp_replace(c, r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}", "")
    return c


def heads(scripts: DataFrame, word: str) -> DataFrame:
    """Rows (id, path, line, arguments, rest) of each ``word (..)`` in the code, wherever its brackets close."""
    pieces = F.split(masked(F.col("text")), rf"(?=\b{word}\s*+\()", -1)
    rows = scripts.select("id", "path", F.posexplode(pieces).alias("n", "piece"))
    above = F.sum(F.length("piece") - F.length(F.replace("piece", F.lit("\n")))).over(Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    inside = INSIDE.replace("[^()]|", "[^()]++|").replace(")*", ")*+")  # as in TOKEN; SQL's patterns have no such loops
    pattern = rf"(?s)^{word}\s*+\(({inside})\)(.*)\z"
    found = rows.withColumn("line", F.coalesce(above, F.lit(0)).cast("int") + 1).filter(F.col("piece").rlike(pattern))
    part = lambda g: F.regexp_extract("piece", pattern, g)
    return found.select("id", "path", "line", part(1).alias("arguments"), part(2).alias("rest"))


def violations(scripts: DataFrame) -> DataFrame:
    """Rows (id, line, rule), one for each violation of scripts and scenes (id, path, text), ids different.

    Line rules are one pass over the lines; parameters and return types follow from whole signatures, wherever they close (four
    brackets deep). Rules of a whole script stand at its line 1. Null texts and paths break no rule.
    """
    where, lines = scopes(), code_lines(scripts)
    found = []
    for rule, scope, column, pattern, group, fits in RULES:
        hits = F.regexp_extract_all(column, F.lit(ALL_LETTERS + pattern), F.lit(group))
        hits = F.filter(hits, lambda x: ~x.rlike(fits)) if fits else hits
        found.append(F.when(where[scope], F.transform(hits, lambda _: F.lit(rule))))
    name, value = F.regexp_extract("code", CONSTANT, 1), F.regexp_extract("said", CONSTANT, 2)
    alias = value.rlike(r"^\s*(?:pre)?load\s*\(") & name.rlike(PASCAL)
    found.append(F.when(where["script"] & F.col("code").rlike(CONSTANT) & ~alias & ~name.rlike(r"^_?[A-Z][A-Z0-9_]*\z"), F.array(F.lit("COD-01"))))
    numbers = F.filter(F.regexp_extract_all("code", F.lit(ALL_LETTERS + NUMBER), F.lit(1)), lambda x: ~x.isin(*PLAIN_NUMBERS))
    found.append(F.when(where["tuned"] & ~F.col("code").rlike(PRIORITY), F.transform(numbers, lambda _: F.lit("DAT-01"))))
    none = F.array().cast("array<string>")
    by_line = lines.select("id", "line", F.explode(F.flatten(F.array(*(F.coalesce(x, none) for x in found)))).alias("rule"))

    signatures = heads(scripts.filter(where["script"]), r"func\b\s*+\w*+")
    untyped = F.size(F.filter(F.split(flat(F.col("arguments")), ","), lambda a: (F.trim(F.regexp_replace(a, r"\s+", " ")) != "") & ~F.split(a, "=")[0].contains(":")))
    returns = F.when(F.col("rest").rlike(r"^\s*->"), 0).otherwise(1)
    of_types = signatures.select("id", "line", F.explode(F.array_repeat(F.lit("COD-02"), untyped + returns)).alias("rule"))
    timers = heads(scripts.filter(where["game"]), "create_timer").withColumn("a", F.split(flat(F.col("arguments")), ","))
    of_timers = timers.filter((F.size("a") < 2) | (F.trim(F.get("a", F.lit(1))) == "true")).select("id", "line", F.lit("SIM-08").alias("rule"))

    facts = lines.filter(where["script"]).groupBy("id", F.split("path", "/")[0].alias("folder")).agg(F.bool_or(F.col("code").rlike(r"^extends\s+Resource\b")).alias("data"), F.bool_or(F.col("code").rlike(r"^class_name\s+\w")).alias("named"))
    whole = F.array_compact(F.array(F.when(~F.col("named"), "DAT-02"), F.when(F.col("folder") != "1_core", "DAT-02")))
    of_data = facts.filter("data").select("id", F.lit(1).alias("line"), F.explode(whole).alias("rule"))
    return by_line.unionByName(of_types).unionByName(of_timers).unionByName(of_data)


# The kinds of faults, their patterns and what they put in place.
SUFFIX = "_mut"
SWAPS = {"<=": "<", "<": "<=", ">=": ">", ">": ">=", "==": "!=", "!=": "=="}
ARITHMETIC = {" + ": " - ", " - ": " + ", " * ": " / ", " / ": " * ", " += ": " -= ", " -= ": " += "}
TYPES = {"float": "int", "int": "float", "bool": "int", "String": "int", "Vector2": "Vector3", "PackedScene": "Script"}
KEYWORDS = "return|if|elif|else|for|while|match|var|const|pass|await|func|signal|break|continue|class_name|extends|static|enum|class|assert"
HIDDEN = "\x00"


def swapped(c: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), c)


def next_number(m: Column) -> Column:
    double = m.cast("double")
    return F.when(m.contains("."), F.when(double == 0, "1.0").otherwise((double * 2).cast("string"))).otherwise((m.cast("decimal(38,0)") + 1).cast("decimal(38,0)").cast("string"))


def typed(m: Column) -> Column:
    name = F.regexp_extract(m, r"(?U)(\w+)\z", 1)
    return F.concat(F.regexp_extract(m, r"(?U)^(.*?)\w+\z", 1), swapped(name, TYPES))


#: Faults that replace a match in the code: name, pattern, replacement (null: no fault).
REPLACED: tuple[tuple[str, str, Callable[[Column], Column]], ...] = (
    ("comparaison_inversee", r"(?<![<>=!\-])(?:<=|>=|==|!=|<(?![<=])|>(?![>=]))", lambda m: swapped(m, SWAPS)),
    ("operateur_arithmetique", r" (?:\+=|-=|\+|-|\*|/) ", lambda m: swapped(m, ARITHMETIC)),
    ("constante_modifiee", r"(?<![\w.])\d+(?:\.\d+)?(?![\w.])", next_number),
    ("chemin_noeud_casse", r"\$[A-Za-z_]\w*(?:/[A-Za-z_]\w*)*", lambda m: F.concat(m, F.lit(SUFFIX))),
    ("await_retire", r"\bawait\s+", lambda m: F.lit("")),
    ("type_exporte", r"(?<=@export var )[A-Za-z_]\w*\s*:\s*[A-Za-z_]\w*", typed),
    ("signal_renomme", r"^signal\s+[A-Za-z_]\w*", lambda m: F.concat(m, F.lit(SUFFIX))),
    ("booleen_inverse", r"\b(?:true|false)\b", lambda m: F.when(m == "true", "false").otherwise("true")),
    ("methode_renommee", r"^(?:static\s+)?func\s+[A-Za-z_]\w*", lambda m: F.concat(m, F.lit(SUFFIX))),
)


def replacements(name: str, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Array of (operator, occurrence, after): each match in ``code`` replaced in ``text``, one at a time."""
    gaps = F.regexp_extract_all("code", F.lit(rf"{ALL_LETTERS}(?s)\G(.*?)(?:{pattern})"), F.lit(1))
    matches = F.regexp_extract_all("code", F.lit(ALL_LETTERS + pattern), F.lit(0))
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x))

    def every(found: Column) -> Column:
        def one(m: Column, k: Column) -> Column:
            start = length(F.slice(found["gaps"], F.lit(1), k + 1)) + length(F.slice(found["matches"], F.lit(1), k))
            after = F.concat(F.substring("text", F.lit(1), start), new(m), F.substring(F.col("text"), start + F.length(m) + 1, F.length("text")))
            return F.struct(F.lit(name).alias("operator"), after.alias("after"), new(m).isNotNull().alias("made"))

        return F.filter(F.transform(found["matches"], one), lambda x: x["made"])

    # most lines have no match, and the gaps are searched only where there are some, each from the end of the match before
    none = F.array().cast("array<struct<operator:string,after:string,made:boolean>>")
    return bound(matches, lambda ms: F.when(F.size(ms) > 0, bound(F.struct(ms.alias("matches"), gaps.alias("gaps")), every)).otherwise(none))


def whole_line_faults() -> list[tuple[str, Column]]:
    """Faults of a line as a whole: their names and arrays of (operator, after, made)."""
    inner, bare = F.col("text").rlike(r"^[\t ]"), F.trim(F.regexp_replace("code", r"^\s+|\s+\z", ""))
    indent = F.regexp_extract("text", r"^(\s*)", 1)
    made = lambda name, test, after: (name, F.when(test, F.array(F.struct(F.lit(name).alias("operator"), after.alias("after"), F.lit(True).alias("made")))))
    call = bare.rlike(r"^[A-Za-z_][\w.]*\(") & bare.endswith(")") & ~bare.rlike(rf"^(?:{KEYWORDS})[.(]") & ~flat(bare).contains("=")
    condition = r"^(\s*(?:if|elif|while)\s+)(.+?)(\s*:\s*)\z"
    lead, body = F.length(F.regexp_extract("code", condition, 1)), F.length(F.regexp_extract("code", condition, 2))
    cut = lambda start, n: F.substring(F.col("text"), start + 1, n)
    negated = F.concat(cut(F.lit(0), lead), F.lit("not ("), cut(lead, body), F.lit(")"), cut(lead + body, F.length("text")))
    signature = r"^((?:static\s+)?func\s+[A-Za-z_]\w*\()(.*)(\)\s*(?:->\s*[^:]+)?:.*)\z"
    head, middle = F.length(F.regexp_extract("code", signature, 1)), F.length(F.regexp_extract("code", signature, 2))
    arguments = cut(head, middle)
    fewer = F.regexp_replace(F.when(arguments.contains(","), F.regexp_replace(arguments, r",[^,]*\z", "")).otherwise(""), r"\s+\z", "")
    shorter = F.concat(cut(F.lit(0), head), fewer, cut(head + middle, F.length("text")))
    plain = F.col("code").rlike(signature) & (F.trim(F.regexp_extract("code", signature, 2)) != "") & ~arguments.rlike(r"[(\[]")
    return [
        made("connexion_supprimee", inner & F.col("code").contains(".connect(") & bare.endswith(")"), F.concat(indent, F.lit("pass"))),
        made("appel_supprime", inner & call, F.concat(indent, F.lit("pass"))),
        made("condition_niee", F.col("code").rlike(condition), negated),
        made("argument_retire", plain, shorter),
    ]


def scene_faults() -> list[tuple[str, Column]]:
    made = lambda name, test, after: (name, F.when(test, F.array(F.struct(F.lit(name).alias("operator"), after.alias("after"), F.lit(True).alias("made")))))
    signal, parent = r'^\[connection signal="([^"]+)"', r'^\[node .*? parent="([^".][^"]*)"'
    put = lambda p: F.regexp_replace("text", rf"({p[:-1]})", f"$1{SUFFIX}")
    return [
        made("connexion_supprimee", F.col("text").rlike(signal), F.lit(None).cast("string")),
        made("signal_renomme", F.col("text").rlike(signal), put(signal)),
        made("chemin_noeud_casse", F.col("text").rlike(parent), put(parent)),
    ]


def mutation_rows(scripts: DataFrame, operators: Collection[str] | None = None) -> DataFrame:
    """Rows (id, line, operator, occurrence, before, after) of every single-line fault of scripts and scenes (id, path, text).

    Strings are masked line by line, as a fault is judged on its line; ``after`` null is the line's deletion. Occurrences count
    the faults of one operator on one line from 0. Blank and comment lines of scripts have none; null texts have none.
    ``operators``: only these are looked for.
    """
    script, scene = F.col("path").endswith(".gd"), F.col("path").endswith(".tscn")
    # text and code leave the generator together, so that no later column masks a line again
    both = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.struct(x.alias("text"), masked(x, HIDDEN).alias("code")))
    lines = scripts.filter(script | scene).select("id", "path", F.posexplode(both).alias("n", "x")).select("id", "path", "n", "x.text", "x.code")
    empty = F.array().cast("array<struct<operator:string,after:string,made:boolean>>")
    live = script & ~F.col("text").rlike(r"^\s*(#|\z)")
    of_script = [(r[0], replacements(*r)) for r in REPLACED] + whole_line_faults()
    # each array has one operator, and a line has one array of it, so a fault's place there is its occurrence and no row is shuffled
    numbered = lambda xs: F.transform(F.coalesce(xs, empty), lambda x, k: F.struct(x["operator"].alias("operator"), k.alias("occurrence"), x["after"].alias("after")))
    found = [(n, F.when(test, x)) for test, faults in ((live, of_script), (scene, scene_faults())) for n, x in faults]
    every = F.flatten(F.array(*(numbered(x) for n, x in found if operators is None or n in operators)))
    rows = lines.select("id", (F.col("n") + 1).alias("line"), F.col("text").alias("before"), F.explode(every).alias("x"))
    return rows.select("id", "line", "x.operator", "x.occurrence", "before", "x.after")


# What a declaration at the top of a script looks like, and words that are no names.
DECLARED = r"^(?:@\w+(?:\([^)]*\))?\s+)*(?:static\s+)?(func|class_name|signal|var|const|enum|extends|class)\s+(\w+)?"
RETURNS = r"\)\s*->\s*([^:]+?)\s*:\s*\z"
WORD = r"(?:^|[^\w.@$])([A-Za-z_]\w*)"
WORDS_OF_THE_LANGUAGE = tuple(f"{KEYWORDS}|and|or|not|in|is|as|self|true|false|null|void|extends|export|onready|preload|super".split("|"))


def script_declarations(scripts: DataFrame) -> DataFrame:
    """Rows (id, kind, name, returns, first, last): each declaration that isn't indented, with the last line of code of its body.

    A body goes on to the next line of code that isn't indented. ``returns`` is the type after the arrow on the first line.
    """
    lines = code_lines(scripts).withColumn("solid", F.col("code").rlike(r"\S")).withColumn("top", F.col("code").rlike(r"^\S"))
    up = Window.partitionBy("id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    piece = lines.withColumn("piece", F.sum(F.col("top").cast("int")).over(up)).filter("piece > 0").groupBy("id", "piece")
    found = piece.agg(F.min("line").alias("first"), F.max(F.when(F.col("solid"), F.col("line"))).alias("last"), F.min_by("code", "line").alias("code"))
    part = lambda g: F.regexp_extract("code", ALL_LETTERS + DECLARED, g)
    return found.filter(F.col("code").rlike(ALL_LETTERS + DECLARED)).select("id", part(1).alias("kind"), part(2).alias("name"), F.regexp_extract("code", RETURNS, 1).alias("returns"), "first", "last")


def declaration_sets(scripts: DataFrame) -> DataFrame:
    """Rows (id, declared, local, used): arrays of the names a script declares at its top, declares inside, and uses from elsewhere.

    A name after a dot belongs to something else; words of the language are no names.
    """
    every = lambda pattern, g=1: F.flatten(F.collect_list(F.regexp_extract_all("code", F.lit(ALL_LETTERS + pattern), F.lit(g))))
    rows = code_lines(scripts).groupBy("id").agg(
        every(r"^(?:@\w+(?:\([^)]*\))?\s+)*(?:static\s+)?(?:func|class_name|signal|var|const|enum|class)\s+(\w+)").alias("d"),
        every(r"^\s+(?:var|const|for)\s+(\w+)").alias("v"), every(r"[(,]\s*(\w+)\s*:").alias("p"), every(WORD).alias("w"),
    )
    own = F.array_sort(F.array_distinct("d"))
    local = F.array_sort(F.array_distinct(F.array_except(F.concat("v", "p"), own)))
    known = F.concat(own, local, F.array(*map(F.lit, WORDS_OF_THE_LANGUAGE)))
    return rows.select("id", own.alias("declared"), local.alias("local"), F.array_sort(F.array_except(F.array_distinct("w"), known)).alias("used"))


def useful_patterns(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Rows (name, hits) of the search patterns that find nothing (0) or something in correct code: one pass, one sum a pattern."""
    counted = lines.agg(*(F.coalesce(F.sum(F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0)))), F.lit(0)).cast("long").alias(n) for n, p in patterns.items()))
    return counted.select(F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("hits")) for n in patterns))))
