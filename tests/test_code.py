"""Masking, rules and faults over code lines: loops over characters and matches, golden scripts, nulls and empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import code, rules


def frame(spark, texts):
    return spark.createDataFrame(texts, "id long, path string, text string").withColumn("line", F.lit(1)).withColumn("code", F.lit(2))


def hide(text: str, blank: str) -> str:
    """One character at a time."""
    out, i = list(text), 0
    while i < len(text):
        start, c = i, text[i]
        if c == "#":
            while i < len(text) and text[i] != "\n":
                i += 1
        elif c in "\"'":
            mark = c * 3 if text[i : i + 3] == c * 3 else c
            i += len(mark)
            while i < len(text) and text[i : i + len(mark)] != mark and not (len(mark) == 1 and text[i] == "\n"):
                i += 2 if text[i] == "\\" and (len(mark) == 3 or text[i + 1 : i + 2] != "\n") else 1
            if text[i : i + len(mark)] == mark:
                i += len(mark)
            i = min(i, len(text))
        else:
            i += 1
            continue
        for k in range(start, i):
            if text[k] != "\n":
                out[k] = blank
    return "".join(out)


def test_masking(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "b = 1", '"', "'", '"""', "#", "\\", "\n", " ", "é"]) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").select("id", code.masked(F.col("text")).alias("m")).collect()
    assert all(r["m"] == hide(texts[r["id"]], " ") for r in got)


SCRIPT = """extends Resource
class_name hero
var a = 1
@export var BadName: int = 2
const Thing = preload("x.tscn")
const wrong := 3
signal Hit
func _process(delta):
	get_node("../x").connect("hit", self)
	Input.is_down()
	var items: Array = []
	var text := "yield(Sprite2D)"  # KinematicBody
func ok(a: int, b: Array[int] = [1, 2],
		c = max(1, 2)) -> Array:
	get_tree().create_timer(2.5)
	get_tree().create_timer(f(1, 2), false)
	process_priority = 7
	x = 12 + randf() + $"/root/Main"
"""


def test_rules_by_folder(spark):
    scripts = frame(spark, [(1, "3_entities/hero.gd", SCRIPT), (2, "3_entities/hero_view.gd", SCRIPT), (3, "addons/hero.gd", SCRIPT), (4, "1_core/a.gd", None), (5, None, SCRIPT), (6, "4_ui/x.tscn", '[node name="bad"]\n[node name="Good"]\nprocess_priority = 3')])
    got = {}
    for r in code.violations(scripts).collect():
        got.setdefault(r["id"], Counter())[(r["line"], r["rule"])] += 1
    always = {
        (1, "DAT-02"): 1, (2, "COD-01"): 1, (3, "COD-02"): 1, (4, "COD-01"): 1, (6, "COD-01"): 1, (7, "COD-01"): 1, (8, "COD-02"): 2, (9, "COD-04"): 1, (11, "COD-02"): 1, (5, "COD-02"): 1, (13, "COD-02"): 1, (14, "COD-02"): 1,
    }
    game = {(9, "ARC-06"): 1, (15, "SIM-08"): 1, (17, "SIM-02"): 1, (18, "ARC-06"): 1}
    logic = {(8, "SIM-01"): 1, (10, "ARC-04"): 1, (18, "SIM-09"): 1, (4, "DAT-01"): 1, (6, "DAT-01"): 1, (13, "DAT-01"): 1, (14, "DAT-01"): 1, (15, "DAT-01"): 1, (16, "DAT-01"): 1, (18, "DAT-01"): 1}
    assert got[3] == always
    assert got[2] == {**got[3], **game} and got[1] == {**got[2], **logic}
    assert got[6] == {(1, "COD-01"): 1, (3, "SIM-02"): 1} and 4 not in got and 5 not in got
    assert code.violations(scripts.limit(0)).count() == 0


def loop_faults(path: str, text: str):
    out = []
    for n, line in enumerate(text.split("\n"), 1):
        if path.endswith(".tscn"):
            if m := re.match(r'\[connection signal="([^"]+)"', line):
                out += [(n, "connexion_supprimee", 0, line, None), (n, "signal_renomme", 0, line, line[: m.end(1)] + "_mut" + line[m.end(1) :])]
            if m := re.match(r'\[node .*? parent="([^".][^"]*)"', line):
                out.append((n, "chemin_noeud_casse", 0, line, line[: m.end(1)] + "_mut" + line[m.end(1) :]))
            continue
        if not line.strip() or line.strip().startswith("#"):
            continue
        shown = hide(line, "\0")
        for name, pattern, _ in code.REPLACED:
            k = 0
            for m in re.finditer(pattern, shown):
                old, new = m[0], None
                if name == "comparaison_inversee":
                    new = code.SWAPS[old]
                elif name == "operateur_arithmetique":
                    new = code.ARITHMETIC[old]
                elif name == "constante_modifiee":
                    new = (repr(float(old) * 2) if float(old) else "1.0") if "." in old else str(int(old) + 1)
                elif name == "await_retire":
                    new = ""
                elif name == "booleen_inverse":
                    new = "false" if old == "true" else "true"
                elif name == "type_exporte":
                    kind = re.search(r"\w+$", old)[0]
                    new = old[: -len(kind)] + code.TYPES[kind] if kind in code.TYPES else None
                else:
                    new = old + "_mut"
                if new is not None:
                    out.append((n, name, k, line, line[: m.start()] + new + line[m.end() :]))
                    k += 1
    return out


def test_faults(spark):
    rng = random.Random(5)
    parts = ["\tif a <= 3 and b:", "a == b", "x -> y", " + ", "1.5", "0", "0.0", "x2", "$A/B", "await ", "@export var v: float", "@export var v: Node", "true", '"1 < 2"', "# 3", "signal s", "func f(a, b)", "static func g()", "<<", "'\\' 1'", "é", "12", " += "]
    texts = [(i, "a/x.gd", "\n".join("".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(6))) for i in range(150)]
    scenes = ['[connection signal="hit" from="A" to="."]', '[node name="X" parent="A/B"]', '[node name="X" parent="."]', "[node]", "x"]
    texts += [(200 + i, "x.tscn", "\n".join(rng.choice(scenes) for _ in range(4))) for i in range(20)] + [(300, "x.txt", "a == b"), (301, "x.gd", None), (302, None, "1")]
    whole = ("connexion_supprimee", "appel_supprime", "condition_niee", "argument_retire")
    got = Counter(tuple(r) for r in code.mutation_rows(frame(spark, texts)).collect() if r["id"] >= 200 or r["operator"] not in whole)
    assert got == Counter((i, *f) for i, p, t in texts if p in ("a/x.gd", "x.gd", "x.tscn") for f in loop_faults(p, t or ""))
    assert code.mutation_rows(frame(spark, texts).limit(0)).count() == 0


def test_faults_of_whole_lines(spark):
    lines = {
        "\tqueue_free()": ("appel_supprime", "\tpass"), "\ta.b.emit(x, f(y == 2))": ("appel_supprime", "\tpass"), "\tx = f()": None, "queue_free()": None, "\treturn(x)": None, "\tf()  # c": None, "\tf(x)[0]": None,
        "  n.hit.connect(g)": ("connexion_supprimee", "  pass"), '\tn.hit.connect("a")': ("connexion_supprimee", "\tpass"),
        "\tif a and \"x:\":": ("condition_niee", '\tif not (a and "x:"):'), "\telif not b :": ("condition_niee", "\telif not (not b) :"), "while x: pass": None, "\tif a: # c": None,
        "func f(a, b: int) -> void:": ("argument_retire", "func f(a) -> void:"), "static func f(a):": ("argument_retire", "static func f():"), "func f():": None, "func f(a = [1], b):": None, 'func f(a, b = ","): # x': ("argument_retire", 'func f(a, b = "): # x'),
    }
    rows = code.mutation_rows(frame(spark, [(i, "x.gd", t) for i, t in enumerate(lines)])).filter(F.col("operator").isin("connexion_supprimee", "appel_supprime", "condition_niee", "argument_retire")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], set()).add((r["operator"], r["after"]))
    for i, (line, want) in enumerate(lines.items()):
        assert (want in got.get(i, ())) if want else i not in got, (line, got.get(i))


@pytest.mark.parametrize("open_, close", [('"', '"'), ("'", "'"), ('"""', '"""'), ("'''", "'''"), ('"', ""), ("'''", "")])
def test_long_strings_are_masked(spark, open_, close):
    """A string of many letters, escapes and quotes of the other kind is one token, closed or not."""
    inside = "ab\\" + open_[0] + ("'" if open_[0] == '"' else '"') + "é"
    text = "x = " + open_ + inside * 40_000 + close + "\ny = 1"
    got = spark.createDataFrame([(text,)], "text string").select(code.masked(F.col("text")).alias("m")).first()["m"]
    spans = len(open_) == 3 and not close
    hidden = len(open_ + inside * 40_000 + close)
    assert got == "x = " + " " * hidden + "\n" + (" " * 5 if spans else "y = 1")


LONG = '\tsay("' + "it's \\\" " * 30_000 + '")'
BODY = "var kept: int = 1\nfunc run(a: int) -> void:\n" + LONG + "\n\tgo(kept)\n"


def test_long_lines_have_names(spark):
    """A line too long for a pattern that uses stack for each character."""
    assert tuple(code.declaration_sets(frame(spark, [(1, "1_core/x.gd", BODY)])).first()) == (1, ["kept", "run"], ["a"], ["go", "int", "say"])


def test_long_lines_in_declarations(spark):
    rows = code.script_declarations(frame(spark, [(1, "1_core/x.gd", BODY)])).orderBy("first").collect()
    assert [tuple(r) for r in rows] == [(1, "var", "kept", "", 1, 1), (1, "func", "run", "void", 2, 4)]


@pytest.mark.parametrize("arguments", ["a" + " " * 60_000 + "b", "a = " + "(" * 3 + "a, " * 50_000 + ")" * 3, "x, " * 50_000])
def test_long_signatures(spark, arguments):
    """Signatures of many letters, closed and not, break rules as short ones do."""
    untyped = 50_000 if arguments.startswith("x") else 1
    for close, found in ((")", untyped + 1), ("", 0)):
        scripts = frame(spark, [(1, "5_data/x.gd", f"func run({arguments}{close}:\n{LONG}\n")])
        assert code.violations(scripts).filter("rule = 'COD-02'").count() == found


def test_long_lines_by_rule(spark):
    scripts = frame(spark, [(1, "5_data/x.gd", BODY + "func Bad(a):\n"), (2, "5_data/y.gd", BODY)])
    assert [tuple(r) for r in rules.by_rule(code.violations(scripts)).collect()] == [(1, 3, "COD-01=1,COD-02=2")]


LINES = ["\tif a <= 1 and b == 2 or a <= 3:", LONG, "\tif a <= 1:  # " + "x" * 200_000]


def test_long_lines_have_faults(spark):
    """Faults are numbered where they are found, so whole lines before and after aren't shuffled."""
    rows = code.mutation_rows(frame(spark, [(1, "1_core/x.gd", "\n".join(LINES))]))
    got = sorted((r["line"], r["operator"], r["occurrence"]) for r in rows.select("line", "operator", "occurrence").collect())
    assert [x for x in got if x[1] == "comparaison_inversee"] == [(1, "comparaison_inversee", 0), (1, "comparaison_inversee", 1), (1, "comparaison_inversee", 2), (3, "comparaison_inversee", 0)]
    assert (2, "appel_supprime", 0) in got
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_asked_faults_only(spark):
    scripts = frame(spark, [(1, "1_core/x.gd", "\n".join(LINES))])
    only = code.mutation_rows(scripts, ("condition_niee",)).collect()
    assert [r["line"] for r in only] == [1]
    assert sorted(only) == sorted(code.mutation_rows(scripts).filter("operator = 'condition_niee'").collect())
