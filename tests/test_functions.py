"""Rules on literal cases."""

from pyspark.sql import functions as F

from shelfmark.functions import (
    arrays, attributes, codes, elements, fingerprints, labels, names, prices, terms, text, texts, urls,
)

V = F.col("v")


def test_replace_first_touches_one_match(evaluate):
    assert evaluate(text.replace_first(V, r"-\d"), ["a-1 b-2", "x", None, "l1\nb-3"]) == ["a b-2", "x", None, "l1\nb"]


def test_strip_knows_unicode_blanks(evaluate):
    assert evaluate(text.strip(V), [" \t a b　\n", ""]) == ["a b", ""]


def test_lenient_numbers(evaluate):
    got = evaluate(text.parse_number(V), ["12abc", " 3.5 ", "", None, "x", "-.5", "1e3z", "5."])
    assert got == [12.0, 3.5, None, None, None, -0.5, 1000.0, 5.0]
    assert evaluate(text.parse_integer(V), ["12abc", "0", "", "x", " 7 ", None]) == [12, None, None, None, 7, None]


def test_cents(evaluate):
    got = evaluate(text.cents(V), [44473.56, 0.285, -0.025, None, 0.0], "v double")
    assert got == [4447356, 28, -2, None, 0]


def test_attributes(spark):
    rows = [([("Number", "N", ""), ("Number", "N", "2"), ("Cost", "C", "3")],), ([],), (None,)]
    df = spark.createDataFrame(rows, "a array<struct<name:string,display_name:string,value:string>>")
    got = df.select(
        attributes.attribute(F.col("a"), "Cost"),
        attributes.attribute(F.col("a"), "Number"),
        attributes.attribute_map(F.col("a")),
        attributes.has_any_attribute(F.col("a"), ["Number"]),
    ).collect()
    assert tuple(got[0]) == ("3", None, {"Number": "", "Cost": "3"}, True)
    assert tuple(got[1]) == (None, None, {}, False)


def test_rules_text(evaluate):
    cases = {
        "Dull: Choose 1 Forward.": "Dull: Choose 1 Forward.",
        "[Dull] Summon: Choose 1 Forward.": "[Dull] Summon: Choose 1 Forward.",
        "[Dull] Other Dull: Choose 1 Forward.": "[Dull] Other : Choose 1 Forward.",
        "Ability: Choose 1 Dull Dull Forward.": "Ability: Choose 1 Dull Forward.",
        "ex burst: This is an ex burst ability.": "EX BURST: This is an EX BURST ability.",
        "<strong>Dull</strong>: Choose 1 Forward.": "Dull: Choose 1 Forward.",
        "a : b : Dull": "a : b : Dull",
        "x :\n [Dull] y": "x: Dull y",
        "Dullness Dull: z": "Dullness : z",
        "[Dull Dull]: z": "[ ]: z",
        "": None,
    }
    assert evaluate(texts.rules_text(V), list(cases)) == list(cases.values())
    kept = evaluate(texts.rules_text(V, keep_cost_words=True), ["[Dull] Other Dull: x"])
    assert kept == ["[Dull] Other Dull: x"]


def test_preferred_text(evaluate):
    cases = [
        ("Old market description", "New source description", "New source description"),
        ("Market description", "", "Market description"),
        ("Market description", None, "Market description"),
        ("Plain text", "[[i]]Italic text[[/]] and [[br]] line break", "<em>Italic text</em> and \n line break"),
        ("", "", None),
        (None, "Source only description", "Source only description"),
        ("own", "《火》《3》《光》", "{F}{3}{L}"),
    ]
    got = evaluate(texts.preferred_text(F.col("v"), F.col("w")), [c[:2] for c in cases], "v string, w string")
    assert got == [c[2] for c in cases]


def test_shrink_level(evaluate):
    got = evaluate(
        texts.shrink_level(F.col("v"), F.col("w")),
        [("abcdefgh", "abcdefghij"), ("abcdefg", "abcdefghij"), ("abc", "abcdefghij")],
        "v string, w string",
    )
    assert got == ["ok", "warn", "raw"]


def test_labels(evaluate):
    wide = {
        "THEATRHYTHM": "Theatrhythm", "theatrhythm": "Theatrhythm", "mobius": "Mobius", "type-0": "Type-0",
        "PICTLOGICA": "Pictlogica", "World of Final Fantasy": "WOFF", "lord of vermilion": "LOV",
        "DFF": "DFF", "FF": "FF", "FFCC": "FFCC", "ADVENT CHILDREN": "Advent Children",
        "Final Fantasy": "Final Fantasy", "vii": "VII", "MIX": "MIX", "X": "X", "123": "123",
    }
    assert evaluate(labels.normalise_label(V), list(wide)) == list(wide.values())
    narrow = {**wide, "MIX": "Mix"}
    assert evaluate(labels.normalise_label(V, "narrow"), list(narrow)) == list(narrow.values())


def test_label_lists(evaluate):
    got = evaluate(labels.categories(V), ["VII;DFF", "DFF", "a · DFF&middot;b;DFF", "", None, " ; "])
    assert got == [["DFF", "VII"], ["DFF"], ["DFF", "a", "b", "DFF"], [], [], []]
    assert evaluate(labels.join_labels(labels.categories(V)), ["VII;DFF", ""]) == ["DFF·VII", None]
    merged = evaluate(
        labels.merged_categories(F.col("v"), F.col("w")),
        [("VII·X", "DFF·X"), ("A", None), (None, None)],
        "v string, w string",
    )
    assert merged == [["DFF", "VII", "X"], ["A"], []]


def test_codes(evaluate):
    cases = {
        "1-044R": "1-044R", "13-114H": "13-114H", "PR-1": "PR-001", "P-055": "PR-055", "Re-4C": "Re-004C",
        "C-4": "C-004", "B-038": "B-038", "00-123A": None, "Promo": None, "XYZ": None, "a 12": "A-012",
        "05-123a": "05-123A", "0-123A": None, "pr000": "PR-000", "Re-4": None, "": None, "10-001L": "10-001L",
        "1-044R ": "1-044R", "A-": None,
    }
    assert evaluate(codes.normalise_code(V), list(cases)) == list(cases.values())
    assert evaluate(codes.is_valid_code(V), ["PR-001", "1-044R", "05-123A", "Re-004C", "X-1"]) == [True] * 4 + [False]
    assert evaluate(codes.is_valid_source_code(V), ["1-044R", "05-123A"]) == [True, False]
    assert evaluate(codes.comparison_form(V), ["PR-055/7-001h", "a b.c,d;e"]) == ["PR0557001H", "ABCDE"]
    loose = {"PR-55/1": "PR-551", "A-123": "A-123", "1-044": "1-044", "13-114h": "13-114H", "xyz": "XYZ"}
    assert evaluate(codes.loose_code(V), list(loose)) == list(loose.values())
    assert evaluate(codes.code_of_key(V), ["PR-055;7-001H_OpusI"]) == ["PR-055/7-001H"]


def test_row_codes(spark):
    rows = [
        ([("Number", "n", "Re-004C/1-044R")],),
        ([("Number", "n", "Re-004C"), ("Number", "n", "Re-005C, Re-004C")],),
        ([("Number", "n", "Promo")],),
        ([],),
    ]
    df = spark.createDataFrame(rows, "a array<struct<name:string,display_name:string,value:string>>")
    got = df.select(codes.row_codes(F.col("a")).alias("c")).select(
        "c", codes.primary_code(F.col("c")), codes.full_code(F.col("c"))
    ).collect()
    assert tuple(got[0]) == (["Re-004C", "1-044R"], "1-044R", "Re-004C/1-044R")
    assert tuple(got[1]) == (["Re-004C", "Re-005C"], "Re-005C", "Re-004C/Re-005C")
    assert tuple(got[2]) == tuple(got[3]) == (None, None, None)


def test_composite_key_and_repairs(spark):
    df = spark.createDataFrame(
        [("PR-055/7-001H", ["Opus I!"], ["1-044R"], "Re-004C/1-044R"), ("1-001C", [], ["Re-004C"], "Re-004C")],
        "code string, s array<string>, c array<string>, f string",
    )
    got = df.select(codes.composite_key(F.col("code"), F.col("s")), codes.repaired_codes(F.col("c"), F.col("f"))).collect()
    assert [tuple(r) for r in got] == [
        ("PR-055;7-001H_OpusI", ["1-044R", "Re-004C"]),
        ("1-001C_Unknown", ["Re-004C"]),
    ]


def test_display_names(evaluate):
    cases = {
        ("Sephiroth (1", None): "Sephiroth",
        ("Sephiroth (B", None): "Sephiroth",
        ("Lightning (19 (Full Art)", None): "Lightning (Full Art)",
        ("Moogle (Class Zero Cadet)", None): "Moogle (Class Zero Cadet)",
        ("Tifa (25th Anniversary Promo)", None): "Tifa (25th Anniversary Promo)",
        ("Locke EX (April 2024)", None): "Locke EX (April 2024)",
        ("Tifa - PR-055/7-001H (Full Art)", ("PR-055", "7-001H")): "Tifa (Full Art)",
        ("Tifa - PR-055", ("PR-055",)): "Tifa (Promo)",
        ("Cloud (1-044R) (Common)", ("1-044R",)): "Cloud",
        ("Cloud (Foo) tail", None): "Cloud",
        ("Cloud (Worlds 2019)", None): "Cloud (Worlds 2019)",
        ("Cloud - 12x (Rare)", None): "Cloud",
        ("  Cloud  Strife ", None): "Cloud Strife",
    }
    got = evaluate(
        names.display_name(F.col("v"), F.col("c")),
        [(n, list(c) if c else None) for n, c in cases],
        "v string, c array<string>",
    )
    assert got == list(cases.values())


def test_search_names(evaluate):
    cases = {
        "Tifa - PR-055/7-001H (Full Art)": "Tifa",
        "Locke EX (April 2024)": "Locke EX",
        "Ace (EX)": "Ace EX",
        "Cloud - 1-044R": "Cloud",
        "Cloud – C-004 - B-001": "Cloud - B-001",
        "Cloud - PR": "Cloud",
    }
    assert evaluate(names.search_name(V), list(cases)) == list(cases.values())


def test_repaired_names(evaluate):
    cases = {
        "Sephiroth (1": "Sephiroth",
        "Sephiroth (B": "Sephiroth",
        "Lightning (19 (Full Art)": "Lightning (Full Art)",
        "Moogle (Class Zero Cadet)": "Moogle (Class Zero Cadet)",
        "Locke EX (April 2024)": "Locke EX (April 2024)",
        "Plain": "Plain",
    }
    assert evaluate(names.repaired_name(V), list(cases)) == list(cases.values())
    assert evaluate(names.has_special_remark(V), ["A (full art)", "A (x)", "Promo"]) == [True, False, False]


def test_terms(evaluate):
    assert evaluate(terms.name_terms(V), ["Cloud", None, "", " "])[:3] == [["c", "cl", "clo", "clou", "cloud"], [], []]
    got = evaluate(
        F.array_sort(terms.code_terms(F.array(V))), ["Re-004C", "13-114H", "abc", "-12", "ab-", "1-2-3", None]
    )
    assert got[0] == sorted(["r", "re", "re-", "re-0", "re-00", "re-004", "re-004c"])
    assert got[1] == sorted(["1", "13", "13-", "13-1", "13-11", "13-114", "13-114h"])
    assert got[2] == ["a", "abc"]
    assert got[3] == ["-"]
    assert got[4] == ["a", "ab", "ab-"]
    assert got[5] == ["1", "1-", "1-2"]
    assert got[6] == []


def test_elements(spark):
    rows = [
        ([("CardType", "t", "Forward"), ("Element", "e", "fire; WATER,")],),
        ([("CardType", "t", "crystal")],),
        ([("Number", "t", "c-004")],),
        ([("CardType", "t", "Sealed Product")],),
        ([("CardType", "t", "Sealed Product"), ("Job", "j", "Knight")],),
        ([],),
    ]
    df = spark.createDataFrame(rows, "a array<struct<name:string,display_name:string,value:string>>")
    a = F.col("a")
    kind, number, element = (attributes.attribute(a, n) for n in ("CardType", "Number", "Element"))
    got = [
        tuple(r)
        for r in df.select(
            elements.row_elements(kind, number, element), elements.row_type(kind, number), elements.is_non_card(kind, a)
        ).collect()
    ]
    assert got == [
        (["Fire", "Water"], "Forward", False),
        (["Crystal"], "crystal", False),
        (["Crystal"], "Crystal", False),
        ([], "Sealed Product", True),
        ([], "Sealed Product", False),
        ([], None, True),
    ]


def test_source_elements_and_rarity(spark):
    df = spark.createDataFrame(
        [("Crystal", "1-001C", None), ("Forward", "C-004", ["火"]), ("Forward", "1-001C", ["火", "x"]), (None, "1-001C", None)],
        "t string, c string, e array<string>",
    )
    got = [r[0] for r in df.select(elements.source_elements(F.col("t"), F.col("c"), F.col("e"))).collect()]
    assert got == [["Crystal"], ["Crystal"], ["Fire", "x"], []]
    got = df.select(elements.rarity_label(F.lit("H"), F.lit(False)), elements.rarity_label(F.lit("H"), F.lit(True)),
                    elements.rarity_label(F.lit("Q"), F.lit(False))).first()
    assert tuple(got) == ("Hero", "Promo", "Q")


def test_urls(evaluate):
    policy = urls.ImagePolicy("cdn.example.net", "https://example.org/none.jpg")
    cases = {
        "https://a/b_200w.jpg": True,
        "https://a/image-missing.svg": False,
        "https://cdn.example.net/cards/full/1_eg.jpg": True,
        "https://cdn.example.net/cards/1_eg.jpg": False,
        "https://a/plain.jpg": False,
        "": False,
        None: False,
    }
    assert evaluate(urls.is_valid_image_url(V, policy), list(cases)) == list(cases.values())
    got = evaluate(urls.url_variants(V, policy), [
        "https://a/b_200w.jpg", "https://cdn.example.net/cards/full/1_eg.jpg",
        "https://cdn.example.net/cards/thumbs/1_eg.jpg", "https://cdn.example.net/x_eg.jpg",
    ])
    assert [tuple(g) for g in got] == [
        ("https://a/b_in_1000x1000.jpg", "https://a/b_400w.jpg", "https://a/b_200w.jpg"),
        ("https://cdn.example.net/cards/full/1_eg.jpg", "https://cdn.example.net/cards/full/1_eg.jpg", None),
        (None, None, "https://cdn.example.net/cards/thumbs/1_eg.jpg"),
        ("https://cdn.example.net/x_eg.jpg", None, None),
    ]
    record = evaluate(urls.image_record(V, policy), [None, "bad", "https://cdn.example.net/cards/thumbs/1_eg.jpg"])
    assert [r["metadata"]["error_message"] for r in record] == ["Image URL missing", "Invalid image URL", None]
    assert record[0]["low_res_url"] == policy.placeholder_url and record[0]["metadata"]["is_placeholder"]
    assert record[2]["full_res_url"].endswith("thumbs/1_eg.jpg") and not record[2]["metadata"]["is_placeholder"]


def test_image_bytes(spark):
    df = spark.createDataFrame(
        [(bytearray(b"\xff\xd8\xff\xe0"),), (bytearray(b"\x89PNG\r\n"),), (bytearray(b"GIF8"),), (bytearray(b"\xff\xd8\xff"),)],
        "b binary",
    )
    assert [r[0] for r in df.select(urls.image_kind(F.col("b"))).collect()] == ["jpeg", "png", None, None]


def test_price_struct(spark):
    df = spark.createDataFrame(
        [((None, 0.285, None, None, 1.0),), (None,)], "p struct<direct_low:double,high:double,low:double,market:double,mid:double>"
    )
    got = [r[0] for r in df.select(prices.price_in_cents(F.col("p"), "Normal")).collect()]
    assert tuple(got[0]) == (None, 28, 0, 0, 100, "Normal") and got[1] is None


def test_fingerprint_text(spark):
    df = spark.createDataFrame([("a/b", None, 3.0, 2.5, ["x"])], "n string, z string, cost double, power double, s array<string>")
    got = df.select(
        fingerprints.canonical_json([F.col("n"), F.col("z"), F.col("cost"), F.col("power"), F.col("s")], ("cost", "power"))
    ).first()[0]
    assert got == '{"n":"a/b","z":null,"cost":3,"power":2.5,"s":["x"]}'
    nested = df.select("n", F.struct("z", "cost").alias("d"), F.struct("z", F.struct("z").alias("y")).alias("e"))
    assert nested.select(fingerprints.compact_json(nested, nested.columns)).first()[0] == '{"n":"a/b","d":{"cost":3.0}}'


def test_array_rules(spark):
    df = spark.createDataFrame([(["b", "A "], ["a", "B"]), ([], ["x"]), (["a", None], ["b"])], "a array<string>, b array<string>")
    got = [tuple(r) for r in df.select(arrays.same_members(F.col("a"), F.col("b")), arrays.overlaps(F.col("a"), F.col("b"))).collect()]
    # sorting comes first, so "b","A " sorts to A,b and "a","B" to B,a
    assert got == [(False, False), (False, False), (False, False)]
    assert df.select(arrays.ordered_union(F.col("b"), F.col("a"))).first()[0] == ["a", "B", "b", "A "]


def test_no_python_in_any_rule_plan(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("v"))
    plan = df.select(
        names.display_name(V, F.array(V)), names.search_name(V), texts.translated_text(V), codes.normalise_code(V)
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEval" not in plan
