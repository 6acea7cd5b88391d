import itertools
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corvane.llm import bloom, components, format_copies, mixing, near_duplicates, packing, pair_defects, pair_features, prefix_join, related_splits, split_overlap, subjects, wordbag
from corvane.llm.canonical import canonical_ir, canonical_svg
from corvane.llm.languages import asked_language, language_of
from corvane.llm.names import author_key, source_key, split_name
from corvane.llm.tokens import encoder
from corvane.workspace import Workspace

RECORD = "id string, prompt string, svg string, diagram_ir string, source string, split string, metadata string, component string, k1 long, h1 long, trains boolean"


def records(spark, *rows):
    """Rows with extra columns whose names the operators use themselves."""
    keys = ["id", "prompt", "svg", "diagram_ir", "source", "split", "metadata"]
    return spark.createDataFrame([(*[r.get(k) for k in keys], "x", 1, 2, None) for r in rows], RECORD)


def bag_alike(a, b):
    words = lambda t: Counter(wordbag._WORD.findall((t or "").lower()))
    x, y = words(a), words(b)
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 0.0


# names and splits


def test_spellings(spark):
    sources = {
        "github:o/r-kit": ["github:o/r-kit", " GitHub:O/R-Kit", "git@git.example:o/r-kit.git", "https://git.example/o/r_kit/", "github:o/r-kit.git"],
        "arxiv:2086.00005": ["arxiv:2086.00005v3", "ARXIV: 2086.00005", "https://papers.example/abs/2086.00005v1", "arXiv:2086.00005"],
        "wikimedia:a-b-drawings": ["wikimedia:a_b_drawings", "Wikimedia:A B Drawings", "https://media.example/wiki/a_b_drawings"],
        "commoncrawl:x-y.example": ["commoncrawl:X-Y.EXAMPLE/", "http://www.x-y.example/", "https://x-y.example/p?q", "commoncrawl:www.x-y.example"],
        "synthetic:batch-00000007": ["synthetic:BATCH-00000007", "synthetic/batch-00000007", "Synthetic:batch_00000007", "synthetic: batch 00000007"],
        None: ["", "  ", "n/a", "Unknown", None],
    }
    rows = spark.createDataFrame([(k, v) for k, vs in sources.items() for v in vs], "want string, given string")
    assert [tuple(r) for r in rows.select("want", source_key(F.col("given")).alias("got"), "given").collect() if r.want != r.got] == []
    names = ["Mío  Ana ", "Ana, Mio", "@mio-ana", "mio.ana", "ana_mio", "MIO ANA", "Mio Ana <mio.ana@mail.example>"]
    keys = {r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(author_key(F.col("n"))).collect()}
    assert keys == {"ana mio"}
    assert [r[0] for r in spark.createDataFrame([(s,) for s in (" TRAIN", "Valid", "test ", "", None, "x")], "s string").select(split_name(F.col("s"))).collect()] == ["train", "val", "test", None, None, None]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(45)] + [("n0", f"hub{k}") for k in range(30)] + [(f"c{k}", f"c{k + 1}") for k in range(20)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    edges = spark.createDataFrame([*pairs, (None, "n1"), ("n0", "n0")], "a string, b string")
    nodes = spark.createDataFrame([(n,) for n in [*parent, "alone", None]], "node string")
    got = {r.node: r.component for r in components.hash_to_min(edges, nodes, Workspace(spark, "t")).collect()}
    assert got == {n: find(n) for n in parent} | {"alone": "alone"}
    assert components.hash_to_min(edges.limit(0), nodes.limit(0), Workspace(spark, "t")).count() == 0


def test_groups_stay_whole_and_crossings_are_found(spark):
    rows = records(
        spark, {"id": "1", "source": "github:a/b", "split": "train", "metadata": '{"author":"Ana Mio"}'}, {"id": "2", "source": "GitHub:A/B", "split": " VALID"}, {"id": "3", "source": "x:1", "metadata": '{"author":"mio, ana"}'},
        {"id": "4", "source": "x:2", "split": "train", "metadata": '{"entity":"e1"}'}, {"id": "5", "split": "train", "metadata": '{"entity":"e1","author":"unknown"}'}, {"id": "6", "metadata": "broken", "split": "test"}, {"id": "7"},
        {"id": "8", "source": "x:9", "metadata": '{"entity":"E1"}', "split": "test"},
    )
    assert sorted(r.id for r in related_splits.crossing(rows).collect()) == ["1", "2", "3"]
    out = {r.id: (r.component, r.new_split) for r in related_splits.assign(rows).collect()}
    assert len({out[k] for k in "123"}) == 1 and len({out[k] for k in "45"}) == 1 and out["6"][0] is None and len(out) == 8
    assert all(v[1] in related_splits.SHARES for v in out.values())
    assert related_splits.crossing(rows.limit(0)).count() == 0 and related_splits.assign(rows.limit(0)).count() == 0


def test_shares_are_met_although_one_source_holds_a_third(spark):
    rows = spark.range(3000).select(F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, "github:big/one").otherwise(F.concat(F.lit("github:o/"), (F.col("id") / 5).cast("int").cast("string"))).alias("source"), F.lit(None).cast("string").alias("split"), F.lit(None).cast("string").alias("metadata"))
    got = {r.new_split: r.share for r in related_splits.shares_reached(related_splits.assign(rows)).collect()}
    assert abs(got["train"] - 0.8) < 0.04 and abs(got["val"] - 0.1) < 0.04 and abs(got["test"] - 0.1) < 0.04


# copies


def test_canonical_forms_ignore_layout_only():
    a = '<svg width="1" height=\'2\'><text x="1">Patent dispute</text><g/></svg>'
    b = "<SVG  height = \"2\"\n width='1' >\n<TEXT x='1'>patent-DISPUTE:</TEXT><g></g>\n</SVG>"
    assert canonical_svg(a) == canonical_svg(b) != canonical_svg(a.replace("Patent", "Patents"))
    assert canonical_svg("<g><a/><b/></g>") != canonical_svg("<g><b/><a/></g>")
    assert canonical_svg(None) == canonical_svg(" \n") == canonical_ir(None) == canonical_ir(" ") == ""
    assert canonical_ir('{"b":[1,2],"a":"X y"}') == canonical_ir('{ "A" : "x-Y." , "b":[1, 2]}') != canonical_ir('{"b":[2,1],"a":"X y"}')
    assert canonical_ir('{"a":') == canonical_ir(' {"A" : ')


def test_copies_and_counts(spark):
    node = '{"nodes":[{"id":"a","kind":"k"}]}'
    rows = records(
        spark, {"id": "c", "svg": "<svg><rect x='1'/></svg>"}, {"id": "b", "svg": '<SVG><RECT X="1"></RECT></SVG>', "diagram_ir": ""}, {"id": "a", "svg": "<svg><rect x='1'/></svg>", "diagram_ir": node},
        {"id": "d", "svg": "<svg/>"}, {"id": "e", "svg": " "}, {"id": "f", "diagram_ir": node}, {"id": "g", "diagram_ir": node.upper().replace("NODES", "nodes"), "svg": ""}, {"id": "h"}, {"id": "i", "svg": "<svg><path d='" + "M1 2" * 60_000 + "'/></svg>"},
    )
    assert sorted(tuple(r) for r in format_copies.copies(rows).collect()) == [("b", "c"), ("f", "g")]
    assert sorted(tuple(r) for r in format_copies.collapse(rows).collect()) == [("a", 1), ("b", 2), ("f", 2), ("i", 1)]
    assert format_copies.copies(rows.limit(0)).count() == 0 and format_copies.collapse(rows.limit(0)).count() == 0


def test_bloom_filters_never_lose_a_repeat(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**62), 2**62, (4000, 2))
    again = keys[:300]
    rows = spark.createDataFrame([tuple(map(int, k)) for k in np.concatenate([keys, again, again])], "a long, b long").repartition(7)
    for bits in (bloom.MIN_BITS, 1 << 20):
        packed = bloom.collect(bloom.build(rows, "a", "b", bits), "again", bits)
        held = {(r.a, r.b) for r in rows.filter(bloom.may_hold(spark, packed, bits, F.col("a"), F.col("b"))).collect()}
        assert {tuple(map(int, k)) for k in again} <= held
    assert len(held) < 600


# near duplicates and overlaps


def drawing(rng, n=60):
    return "<svg>" + "".join(f"<text x='{rng.randint(0, 1500)}' y='{rng.randint(0, 1500)}'>w{rng.randint(0, 3000)}</text>" for _ in range(n)) + "</svg>"


def near_table(seed=4, groups=25):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        prompt, svg = " ".join(f"p{rng.randint(0, 900)}" for _ in range(60)), drawing(rng)
        for k in range(rng.randint(1, 4)):
            words, changed = prompt.split(), svg
            for _ in range(k):
                words[rng.randrange(len(words))] = f"q{rng.randint(0, 99)}"
                changed = changed.replace("<text", "<text fill='red'", 1)
            rng.shuffle(words)
            rows.append({"id": f"r{g:02d}{k}", "prompt": " ".join(words), "svg": changed, "split": rng.choice(["train", "Train", "val", "test ", "", None]), "source": f"github:o/{g % 3}"})
    rows += [{"id": "z0", "prompt": rows[0]["prompt"].upper(), "svg": rows[0]["svg"], "split": "val"}, {"id": "z1", "prompt": rows[0]["prompt"], "svg": None, "split": "train"}, {"id": "z2", "prompt": None, "svg": rows[0]["svg"]}, {"id": "z3", "prompt": "", "svg": "<svg/>"}, {"id": "z4", "prompt": "no markup", "svg": rows[0]["svg"].replace("<svg>", "")}]
    return rows


def brute(rows):
    good = [r for r in rows if r["prompt"] and r["svg"] and "<svg" in r["svg"]]
    return {tuple(sorted((a["id"], b["id"]))) for i, a in enumerate(good) for b in good[i + 1 :] if bag_alike(a["prompt"], b["prompt"]) >= 0.8 and bag_alike(a["svg"], b["svg"]) >= 0.8}


def test_copies_in_slices_equal_copies_in_one_filter(spark, monkeypatch):
    rng = random.Random(4)
    rows = records(spark, *[{"id": f"r{k:04d}", "svg": f"<svg><rect x='{rng.randint(1, 600)}'/></svg>"} for k in range(900)])
    want = sorted(tuple(r) for r in format_copies.copies(rows).collect())
    counted = sorted(tuple(r) for r in format_copies.collapse(rows).collect())
    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 12)
    monkeypatch.setattr(bloom, "MIN_BITS", 1 << 10)
    assert bloom.slices_for(900) == 3
    assert sorted(tuple(r) for r in format_copies.copies(rows).collect()) == want
    assert sorted(tuple(r) for r in format_copies.collapse(rows).collect()) == counted


def test_near_pairs_and_overlaps_equal_brute_force(spark):
    rows = near_table()
    want = brute(rows)
    table = records(spark, *rows)
    assert len(want) > 20
    assert sorted(tuple(r) for r in near_duplicates.record_pairs(table).collect()) == sorted(want)
    links = {r.id: r for r in near_duplicates.record_links(table).collect()}
    assert all(links[i].n_links == sum(i in p for p in want) for i in links) and links["z0"].class_id == "r000"
    side = {r["id"]: {"train": "t", "val": "e", "test": "e"}.get((r.get("split") or "").strip().lower()) for r in rows}
    cross = {p for p in want if {side[p[0]], side[p[1]]} == {"t", "e"}}
    assert cross and sorted(tuple(r) for r in split_overlap.overlapping_pairs(table).collect()) == sorted(cross)
    counts = split_overlap.overlap_counts(table).collect()
    assert sum(r.exact_records + r.near_records for r in counts) == len({i for p in cross for i in p if side[i] == "e"})
    for op in (near_duplicates.record_pairs, near_duplicates.record_links, split_overlap.overlapping_pairs, split_overlap.overlap_counts):
        assert op(table.limit(0)).count() == 0


def threshold_table(seed=11, groups=60, words=200):
    """Pairs alike at 0.80 to 0.86 in both texts, one of which may be longer."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        split = ["train", "val"] if g % 2 else ["test", "train"]
        texts = [[f"{t}{rng.randint(0, 700)}" for _ in range(words)] for t in "ps"]
        other = []
        for text in texts:
            copy, more = list(text), rng.choice([0, 0, 10])
            for at in rng.sample(range(words), int(words * rng.choice([0.14, 0.17, 0.19, 0.2])) - more // 2):
                copy[at] = f"new{rng.randint(0, 10**6)}"
            other.append(copy + [f"more{rng.randint(0, 10**6)}" for _ in range(more)])
        for k, (prompt, svg) in enumerate((texts, other)):
            rows.append({"id": f"t{g:02d}{k}", "prompt": " ".join(prompt), "svg": "<svg>" + " ".join(svg) + "</svg>", "split": split[k], "source": "x:1"})
    return rows


@pytest.mark.parametrize("chunk", [100_000, 40])
def test_near_pairs_at_the_threshold_are_all_found(spark, monkeypatch, chunk):
    monkeypatch.setattr(prefix_join, "CHUNK", chunk)
    rows = threshold_table()
    want = brute(rows)
    assert len(want) > 40
    assert sorted(tuple(r) for r in near_duplicates.record_pairs(records(spark, *rows)).collect()) == sorted(want)
    assert {r.id for r in near_duplicates.record_links(records(spark, *rows)).filter("n_links > 0").collect()} == {i for p in want for i in p}


def test_counts_above_two_bytes_are_told_apart():
    _, columns = wordbag.sketch(["1", "2", "3"], ["p"] * 3, ["a " * 70_000 + "b", "a " * 200_000 + "b", "a " * 9 + "b"], wordbag._Hashes())
    bags = columns[-1].to_pylist()
    assert wordbag.likeness(bags[0], bags[1]) == (1.0, 2 * 70_001 / 270_002) and wordbag.likeness(bags[1], bags[2]) == (1.0, 20 / 200_011) and wordbag.likeness(bags[1], bags[1]) == (1.0, 1.0)


def test_overlaps_at_the_threshold_are_all_found(spark):
    rows = threshold_table()
    want = brute(rows)
    assert sorted(tuple(r) for r in split_overlap.overlapping_pairs(records(spark, *rows)).collect()) == sorted(want)
    assert sum(r.near_records for r in split_overlap.overlap_counts(records(spark, *rows)).collect()) == len(want)


def one_task(seed=5, texts=1500):
    """Texts of words of a small vocabulary, every tenth a near copy of another, as the rows of one task."""
    rng = np.random.default_rng(seed)
    common = np.sort(rng.choice(1 << 32, 600, replace=False).astype(np.uint32))
    held = []
    for k in range(texts):
        if k % 10:
            held.append(rng.choice(common, rng.integers(60, 160), replace=False))
        else:
            text = held[int(rng.integers(len(held)))] if held else common[:80]
            held.append(np.unique(np.concatenate([text[int(len(text) * rng.uniform(0, 0.22)) :], rng.choice(common, rng.integers(0, 12), replace=False)])))
    n = np.array([len(x) for x in held])
    words, owner, at = prefix_join._ordered(np.concatenate(held), n, np.arange(prefix_join.BUCKETS, dtype=np.uint32))
    kept = np.nonzero(at < prefix_join.prefix(n, 0.8)[owner])[0]
    mine, bits = owner[kept], prefix_join.residues(words, owner, texts).view(np.int64)
    ones = np.ones(len(kept), np.int32)
    columns = {"side": 0 * ones, "w": words[kept].astype(np.int64), "n": n[mine].astype(np.int32), "at": at[kept].astype(np.int32), "m": ones, "role": 3 * ones, "k1": mine, "k2": 0 * mine}
    shared = np.zeros((texts, len(common)), np.float32)
    shared[np.repeat(np.arange(texts), n), np.searchsorted(common, np.concatenate(held))] = 1
    alike = 2 * (shared @ shared.T) >= 0.8 * (n[:, None] + n[None, :]) - 1e-9
    return pa.table(columns | {f"b{k}": bits[mine, k] for k in range(prefix_join.BITS)}), {(i, j) for i, j in np.argwhere(alike).tolist() if i < j}


@pytest.mark.parametrize(("wide", "front"), [(1 << 30, 1 << 16), (1, 1 << 16), (1, 300), (40, 3000)])
def test_rows_spelled_out_and_rows_in_blocks_meet_all_alike_texts(monkeypatch, wide, front):
    monkeypatch.setattr(prefix_join, "WIDE", wide)
    monkeypatch.setattr(prefix_join, "FRONT", front)
    table, want = one_task()
    found = prefix_join._join_task(table, 0.8, False)
    assert len(want) > 100 and want <= set(zip(found.column("a1").to_pylist(), found.column("b1").to_pylist(), strict=True))


@pytest.mark.parametrize("wide", [1 << 30, 64])
def test_words_compared_stay_few(monkeypatch, wide):
    """A row whose word comes late meets hardly longer texts only, and what the first bits let pass is little."""
    monkeypatch.setattr(prefix_join, "WIDE", wide, raising=False)
    table, count, seen = one_task()[0], np.bitwise_count, [0]

    def counted(x, *args, **kw):
        seen[0] += x.size
        return count(x, *args, **kw)

    monkeypatch.setattr(prefix_join.np, "bitwise_count", counted)
    prefix_join._join_task(table, 0.8, False)
    lists = np.unique(table.column("w").to_numpy(), return_counts=True)[1]
    assert seen[0] < 0.8 * (lists**2).sum()


def test_prefix_join_drops_no_alike_pair_whatever_the_block():
    first, blocks = prefix_join.plan(np.array([30, 0, 5, 250_000, 70_000, 50_000]))
    assert blocks.tolist() == [1, 1, 1, 3, 1, 1] and first.tolist() == [0, 0, 0, 1, 7, 8]
    at, task, side = prefix_join.placed(first[[3, 3, 3]], blocks[[3, 3, 3]], np.array([0, 1, 2]))
    held = {}
    for row, t, s in zip(at.tolist(), task.tolist(), side.tolist(), strict=True):
        held.setdefault(t, []).append((s, row))
    assert sorted(map(sorted, held.values())) == [[(0, 0)], [(0, 1)], [(0, 2)], [(1, 0), (2, 1)], [(1, 0), (2, 2)], [(1, 1), (2, 2)]]


def test_languages():
    assert language_of("Zeichne ein Bild mit dem Titel") == "de" and language_of("") == "en"
    assert asked_language("Draw a chart. Labels: Spanish.") == "es"
    assert asked_language("Zeichne ein Bild. Die Leser sprechen nur Französisch, bitte so beschriften.") == "fr"
    assert asked_language("Draw how the French press works.") == "en"


def defect_base(n=420):
    words = {"en": "river bridge tower garden kitchen window market school", "de": "fluss brücke turm garten küche fenster schule werkstatt", "fr": "rivière maison jardin fenêtre marché école atelier cuisine", "es": "puente torre jardín cocina ventana mercado escuela taller"}
    asks = {"en": "Draw a chart of the {} and the {} with arrows to the {}.", "de": "Zeichne ein Bild mit dem {} und der {} und führe zu {}.", "fr": "Dessine un schéma avec le {} et la {} pour les {}.", "es": "Dibuja un mapa con el {} y la {} para los {}."}
    rng, out = random.Random(8), []
    for k in range(n):
        lang = ["en", "de", "fr", "es"][k % 4]
        chosen = rng.choices(words[lang].split(), k=7)
        texts = "".join(f'<rect x="{rng.randint(1, 900)}" y="{rng.randint(1, 900)}" width="80" height="40" fill="#eeeeee"/><text x="{rng.randint(1, 900)}" y="9">{w}</text>' for w in chosen)
        out.append((f"d{k:03d}", asks[lang].format(*chosen[:3]) + " Keep " * (lang == "en") + " ".join(chosen), f'<svg xmlns="http://www.w3.org/2000/svg" width="900" height="900">{texts}</svg>'))
    return out


def test_defects_on_held_out_rows(spark):
    base = defect_base()
    rows = [{"id": i, "prompt": p, "svg": s} for i, p, s in base]
    other = {k: base[k][2] for k in range(8)}
    planted = {
        "x0": ("empty", base[0][1], " \n"), "x1": ("empty", base[1][1], "<svg/>"), "x2": ("truncated", base[2][1], base[2][2][: len(base[2][2]) // 2]), "x3": ("truncated", base[3][1], base[3][2][:-40] + "..."),
        "x4": ("refusal", base[4][1], "I'm sorry, but I cannot draw this bridge."), "x5": ("refusal", base[5][1], "<!-- Leider kann ich das nicht zeichnen. -->"), "x6": ("copied_prompt", base[6][1], base[6][1]),
        "x7": ("copied_prompt", base[7][1], "Prompt: " + base[7][1].upper()), "x8": ("other_language", base[8][1], other[1]), "x9": ("other_language", base[9][1], other[2]),
    }
    rows += [{"id": i, "prompt": p, "svg": s} for i, (_, p, s) in planted.items()]
    rows += [{"id": "y0", "prompt": None, "svg": base[0][2]}, {"id": "y1", "prompt": base[0][1]}, {"id": "y2", "prompt": base[0][1], "svg": "", "diagram_ir": '{"nodes":[{"id":"a","kind":"k","label":"river"},{"id":"b","kind":"k","label":"tower"}],"edges":[]}'}, {"id": "y3", "prompt": base[0][1], "svg": "x" * 300_000}]
    got = {r.id: r.defect for r in pair_defects.defects(records(spark, *rows)).collect()}
    assert sum(got.get(i) == planted[i][0] for i in planted) >= 8
    assert got["y1"] == "empty" and sum(i.startswith("d") for i in got) <= 8
    assert pair_defects.defects(records(spark, *rows).limit(0)).count() == 0


LATE = "i am sorry but i cannot draw {}"


def test_what_is_said_late_is_looked_at():
    chat = " ".join(f"chat{k}" for k in range(400))
    box = '<rect x="1" y="1" width="9" height="9"/>'
    features = pair_features.Features()
    for target in (f"{chat} {LATE} {chat}", f"<svg><text>{chat} {LATE}</text></svg>", f"<svg>{box * 3}<text>{chat} {LATE}</text></svg>", f"<svg>{box * 3}<text>{chat} {chat}</text><text>{LATE} and no further elements</text></svg>"):
        _, windows = features("Draw a bridge.", target)
        want = set(pair_features._speech(pair_features._own(LATE.replace("{}", "").split(), {"draw", "a", "bridge"}))[0])
        assert max(len(want & set(places)) for places, _ in windows) >= len(want) - 1


def test_a_late_refusal_counts_in_long_texts():
    base = defect_base()
    weights, limits = pair_defects.fit(pair_defects.featured_pairs([(p, s) for _, p, s in base], 0, 5))
    features, refusal = pair_features.Features(), pair_defects.DEFECTS.index("refusal")
    boxes = '<rect x="1" y="1" width="9" height="9"/>' * 3
    for k in (0, 40):
        chat = " ".join([base[k][1]] * 10)
        for form in ("{}", "<svg><text>{}</text></svg>", f"<svg>{boxes}<text>{{}}</text></svg>"):
            with_it, without = pair_defects.judged(weights, [features(base[k][1], form.format(chat + end)) for end in (" I'm sorry, but I cannot draw this bridge.", "")]) - limits
            assert with_it[refusal] > without[refusal] + 2 and (boxes in form or with_it[refusal] > 0)


# constructions that no list of the package has
UNSEEN = {
    "en": ["Drawing {} is off the table for me.", "Nope, {} isn't happening.", "Apologies, {} falls outside what I do.", "I have been told never to render {}.", "Could somebody else take on {}? I won't.", "That sketch of {} is one I have to skip.", "Producing {} goes past my limits.", "I'm unwilling to put {} on paper."],
    "de": ["Von {} lasse ich lieber die Finger.", "{} gibt es von mir nicht.", "Daraus wird nichts: {} zeichne ich keinesfalls.", "So etwas wie {} male ich grundsätzlich nie.", "Zu {} liefere ich keine Skizze.", "Mir wurde verboten, {} abzubilden.", "Das Motiv {} muss ich auslassen.", "Ich bin nicht in der Lage, {} umzusetzen."],
    "fr": ["Désolée, {} ne sera pas dessiné par mes soins.", "Je m'abstiens de dessiner {}.", "Impossible pour moi de figurer {}.", "On m'a interdit de montrer {}.", "Je ne me charge pas de {}.", "Non, je ne fais pas {}.", "Je suis dans l'incapacité de produire {}.", "Ce sujet, {}, je dois l'écarter."],
    "es": ["Me abstengo de dibujar {}.", "Imposible para mí plasmar {}.", "Me han vetado mostrar {}.", "No me encargo de {}.", "No, yo no hago {}.", "Soy incapaz de producir {}.", "Este tema, {}, debo descartarlo.", "Disculpa, {} queda fuera de lo que hago."],
}
FORMS = {
    "bare": "{}", "svg": '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 900 900"><text x="20" y="40">{}</text></svg>', "comment": "<!-- {} -->",
    "ir": '{{"schema_version":"0.1","diagram_type":"process","title":"Figure","nodes":[{{"id":"n1","kind":"box","label":"{}"}}],"edges":[],"groups":[]}}',
}


def test_refusals_in_unseen_words_are_found_in_every_form():
    table = "/root/testdata/sf0.01/training_records.parquet"
    if not os.path.exists(table):
        pytest.skip("needs the driver's tables")
    rows = pq.read_table(table, columns=["prompt", "svg", "diagram_ir"]).to_pylist()
    base = [(r["prompt"], t) for r in rows for t in [r["svg"] or r["diagram_ir"]] if r["prompt"] and t and len(t) > 200 and pair_features.looks_like(t) != "bare"]
    weights, limits = pair_defects.fit(pair_defects.featured_pairs(base, 0, 5))
    features, refusal, hits, tried = pair_features.Features(), pair_defects.DEFECTS.index("refusal"), Counter(), Counter()
    for lang, phrases in UNSEEN.items():
        prompts = [p for p, _ in base if language_of(p) == lang][:4]
        for phrase, (form, shell), prompt in itertools.product(phrases, FORMS.items(), prompts):
            over = pair_defects.judged(weights, [features(prompt, shell.format(phrase.format(" ".join(prompt.split()[4:7]).replace('"', ""))))])[0] - limits
            hits[form] += int(over.argmax() == refusal and over[refusal] > 0)
            tried[form] += 1
    assert all(hits[form] >= 0.9 * tried[form] for form in FORMS), (hits, tried)


def test_small_tables_are_judged_too(spark):
    _, prompt, svg = defect_base(4)[0]
    rows = [{"id": "a", "prompt": prompt}, {"id": "b", "prompt": prompt, "svg": " ", "diagram_ir": ""}, {"id": "c", "prompt": prompt, "svg": svg}, {"id": "d", "prompt": prompt, "svg": "I'm sorry, but I cannot draw this bridge."}]
    got = {r.id: r.defect for r in pair_defects.defects(records(spark, *rows)).collect()}
    assert got == {"a": "empty", "b": "empty", "d": "refusal"}


# packing, mixing, subjects


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, source string, tokens string, h int")


def test_fullest_bin_equals_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        capacity = rng.randint(10, 40)
        counts = Counter(rng.randint(1, capacity) for _ in range(9))
        lengths = sorted(counts, reverse=True)
        items = list(counts.elements())
        items.remove(lengths[0])
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        best = max(s for s in sums if s <= capacity - lengths[0])
        taken = packing.fullest(lengths, counts, capacity)
        assert sum(k * n for k, n in taken.items()) == best + lengths[0] and all(n <= counts[k] for k, n in taken.items())


def test_every_token_is_packed_once(spark):
    rng = random.Random(6)
    texts = ["word " * rng.randint(1, 90) for _ in range(300)] + ["a b " * 700, None, "", "é" * 20_000]
    docs = documents(spark, [(k, t, "s") for k, t in enumerate(texts)])
    sizes = spark.createDataFrame([("small", 64), ("large", 512), ("none", 0), ("null", None)], "profile string, capacity_tokens int")
    enc = encoder()
    want = {k: len(enc.encode_ordinary(t)) for k, t in enumerate(texts) if t}
    packed = packing.pack(docs, sizes).collect()
    for profile, capacity in (("small", 64), ("large", 512)):
        mine = [r for r in packed if r.profile == profile]
        held, fill, pieces = Counter(), Counter(), {}
        for r in mine:
            held[r.doc_id] += r.tokens
            fill[r.container_id] += r.tokens
            pieces.setdefault(r.doc_id, []).append((r.start, r.tokens))
        assert dict(held) == want and max(fill.values()) <= capacity
        assert all(len(p) == 1 for d, p in pieces.items() if want[d] <= capacity)
        assert all(sum(t for s, t in sorted(p)[:k]) == s for p in pieces.values() for k, (s, _) in enumerate(sorted(p)))
        assert len(fill) <= -(-sum(want.values()) // capacity) * 1.03 + 1
    assert {r.profile for r in packed} == {"small", "large"}
    report = {r.profile: r.fill for r in packing.fill_report(packing.pack(docs, sizes), sizes).collect()}
    assert report["small"] > 0.95
    assert packing.pack(docs.limit(0), sizes).count() == 0 and packing.pack(docs, sizes.limit(0)).count() == 0


def test_long_capacities_and_many_profiles_never_overfill(spark):
    rng = random.Random(5)
    sizes = [rng.choice([rng.randint(1, 90_000), rng.randint(60_000, 140_000), 65_536, 70_000]) for _ in range(24)]
    docs = spark.createDataFrame([(k, " a" * n) for k, n in enumerate(sizes)], "doc_id long, text string")
    few = spark.createDataFrame([("big", 131_072), ("mid", 40_000), ("mid", 30_000), (None, 7), ("none", 0)], "profile string, capacity_tokens int")
    assert sorted(tuple(r) for r in packing.invariants(docs, few).collect()) == [("big", 0, 0, 0), ("mid", 0, 0, 0)]
    assert {(r.profile, r.containers >= r.fewest_containers) for r in packing.fill_report(packing.pack(docs, few), few.filter("capacity_tokens > 30000")).collect()} == {("big", True), ("mid", True)}
    small = spark.createDataFrame([(k, " a" * rng.randint(0, 300)) for k in range(150)], "doc_id long, text string")
    many = spark.createDataFrame([(f"p{k}", 10 + k) for k in range(200)], "profile string, capacity_tokens int")
    checked = packing.invariants(small, many).collect()
    assert len(checked) == 200
    assert all((r.overfull, r.uncovered, r.divided) == (0, 0, 0) for r in checked)
    assert packing.invariants(small, many.filter("false")).count() == 0


def test_mixtures_reach_their_shares(spark):
    rng = random.Random(9)
    rows = [(k, "word " * rng.randint(3, 30), ["Big One", "big-one ", "small", "other"][min(3, rng.randrange(12))]) for k in range(2400)] + [(9001, None, "small"), (9002, "x", None), (None, "x", "small")]
    targets = spark.createDataFrame([("big-one", 0.6, 1), ("SMALL", 0.4, 3), ("gone", 0.2, 2), ("zero", None, 1)], "source string, target_share double, max_repeats int")
    used, report = mixing.mix(documents(spark, rows), targets)
    got = {r.source: r for r in report.collect()}
    assert set(got) == {"big-one", "small", "gone"} and got["gone"].used_tokens == 0
    assert abs(got["big-one"].actual_share - 0.6) < 0.01 and abs(got["small"].actual_share - 0.4) < 0.01
    assert max(got["small"].used_tokens / (3 * got["small"].available_tokens), got["big-one"].used_tokens / got["big-one"].available_tokens) > 0.97
    assert all(r.uses <= {"big-one": 1, "small": 3}[r.source] for r in used.collect())
    empty, none = mixing.mix(documents(spark, rows).limit(0), targets)
    assert empty.count() == 0 and all(r.used_tokens == 0 for r in none.collect())


def test_subjects_of_mixed_documents(spark):
    vocabulary = {"law": "judge court lawyer verdict appeal statute clause".split(), "sport": "goal referee match player coach league stadium".split(), "cooking": "oven salt onion kitchen recipe butter flour".split()}
    stock = ["The palette stays as it was.", "Fonts are embedded as outlines.", "Please check the spacing again."]
    rng, rows, want = random.Random(3), [], {}

    def sentence(subject):
        a, b = rng.sample(vocabulary[subject], 2)
        return f"The drawing shows the {a} next to the {b}."

    for k in range(900):
        first, second = rng.sample(sorted(vocabulary), 2)
        parts = [sentence(first) for _ in range(6)] + [sentence(second) for _ in range(rng.choice([0, 0, 0, 3]))]
        want[k] = {first, second} if len(parts) > 6 else {first}
        parts += rng.choices(stock, k=4)
        rng.shuffle(parts)
        rows.append((k, " ".join(parts), "s"))
    rows += [(5000, None, "s"), (5001, "", "s"), (5002, stock[0], "s"), (5003, "court " * 50_000, "s"), (5004, rows[0][1], "s")]
    examples = spark.createDataFrame([(k, " ".join(sentence(s) for _ in range(3)), s) for k, s in enumerate(sorted(vocabulary) * 8)] + [(99, None, "law")], "example_id long, text string, subject string")
    got = {}
    for r in subjects.document_subjects(documents(spark, rows), examples).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert sum(got.get(k) == want[k] for k in want) >= 0.97 * len(want)
    assert 5000 not in got and 5001 not in got and got[5004] == got[0]
    assert subjects.document_subjects(documents(spark, rows).limit(0), examples).count() == 0
    assert subjects.document_subjects(documents(spark, rows), examples.limit(0)).count() == 0
