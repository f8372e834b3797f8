import random

from pyspark.sql import functions as F

from tokenloom.functions.detect import detect_content_type, type_from_filename
from tokenloom.functions.numeric import price_lookup, py_round


def test_filename_rules(spark):
    names = ["a.py", "data.json", "x.md", "transcript_sample.txt", "otter_notes", "potter.html",
             "", None, "README", "MAIN.GO"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(type_from_filename(F.col("n"))).collect()]
    assert got == ["code", "code", "document", "document", "transcript", "transcript",
                   None, None, None, "code"]


def test_signal_quirks(spark):
    texts = [
        "bcc: someone",                               # bcc contains cc -> email
        "From: a\nSubject: b\nhello",                 # email
        "Speaker 1 [Ann]: 0:05 um okay",              # transcript
        "import x def f class C",                     # code
        "bob: lol brb",                               # chat (anchored name)
        "hello\nbob: lol",                            # ^ is text start only -> one signal
        "<html><div>https://x",                       # web page
        "a plain document",                           # 'um' inside 'document' is one signal only
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(detect_content_type(F.col("t"))).collect()]
    assert got == ["email", "email", "transcript", "code", "chat", "document", "web_page", "document"]


def test_price_resolution(spark):
    names = ["gpt-4o", "gpt-4o-mini", "gpt-4o-mini-2024-07-18", "gpt-4", "", "claude-3",
             "unknown-x", "mistral-small", "gemini-pro-1.5"]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = [r[0] for r in df.select(price_lookup(F.col("m"))["model_key"]).collect()]
    assert got == ["gpt-4o", "gpt-4o-mini", "gpt-4o", "gpt-4o", "gpt-4o", "claude-3-opus",
                   "gpt-4o-mini", "mistral-small", "gemini-pro"]


def test_py_round_matches_python(spark):
    random.seed(5)
    vals = [81.25, 99.35, 0.8995, -2.5, 2.5, 0.0, 1e-9, 123.456789]
    pairs = [(random.randint(0, 3000), random.randint(1, 3000)) for _ in range(3000)]
    vals += [(1 - (o / r)) * 100 for o, r in pairs] + [1 - (1 - (o / r)) for o, r in pairs]
    vals += [random.uniform(-1000, 1000) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select("x", py_round(F.col("x"), 1).alias("r1"), py_round(F.col("x"), 3).alias("r3")).collect()
    for r in rows:
        assert r.r1 == round(r.x, 1), r.x
        assert r.r3 == round(r.x, 3), r.x


def test_price_table_join_matches_case(spark):
    from tokenloom import config as C
    from tokenloom.operators.metrics import resolve_price_table

    names = ["gpt-4o-mini-2024-07-18", "gpt-4", "", "claude-3", "unknown-x", "mistral-large"]
    models = spark.createDataFrame([(n,) for n in names], "model string")
    got = {r.model: r.model_key for r in resolve_price_table(models, C.price_table(spark)).collect()}
    want = {r.m: r.k for r in models.select(F.col("model").alias("m"),
                                            price_lookup(F.col("model"))["model_key"].alias("k")).collect()}
    assert got == want


def test_price_table_of_any_names(spark):
    import random

    from tokenloom.operators.metrics import resolve_price_table

    rng = random.Random(1)

    def first(rows):
        return min(rows, key=lambda p: (p[1], p[0]), default=None)

    for letters, least, default in (("abcé-🎉", 0, "none"), ("abc", 1, None), ("ab", 0, None)):
        def word(n=least):
            return "".join(rng.choice(letters) for _ in range(rng.randint(n, 7)))

        rows = [(word(), rng.randint(0, 50), i * 1.0, i * 2.0) for i in range(40)]
        rows += [(None, 0, 9.0, 9.0), (rows[3][0], 99, 5.0, 5.0)]
        default = default or rows[5][0]
        prices = spark.createDataFrame(rows, "model_key string, ordinal long, input_per_1k double, output_per_1k double")
        names = [(word(0),) for _ in range(200)] + [(None,), ("zzzz",), ("",)]
        got = {r[0]: tuple(r)[1:] for r in resolve_price_table(spark.createDataFrame(names, "model string"), prices, default=default).collect()}
        real = [p for p in rows if p[0] is not None]
        for (m,) in names:
            best = None
            if m is not None:
                best = first([p for p in real if p[0] == m]) or first([p for p in real if p[0] in m or m in p[0]])
            best = best or first([p for p in real if p[0] == default]) or (default, None, None, None)
            assert got[m] == (best[0], best[2], best[3]), m


def test_price_table_of_many_keys_has_no_nested_loop(spark):
    from tokenloom.operators.metrics import resolve_price_table

    prices = spark.range(100_000).select(F.concat(F.lit("model-"), F.hex("id"), F.lit("-x")).alias("model_key"),
                                         F.col("id").alias("ordinal"), (F.col("id") / 10).alias("input_per_1k"))
    models = spark.createDataFrame([("model-FF-x",), ("my model-1A2-x today",), ("-F",), ("",), ("other",)], "model string")
    out = resolve_price_table(models, prices, default="model-7-x")
    got = {r.model: (r.model_key, r.input_per_1k) for r in out.collect()}
    assert got == {"model-FF-x": ("model-FF-x", 25.5), "my model-1A2-x today": ("model-1A2-x", 41.8), "-F": ("model-F-x", 1.5),
                   "": ("model-0-x", 0.0), "other": ("model-7-x", 0.7)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_build_prompts_matches_template(spark):
    from tokenloom import config as C
    from tokenloom.operators.summarize import build_prompts

    text = "Line one.\nLine two." * 800
    df = spark.createDataFrame([(text, 321, "email")], "norm_text string, target_tokens long, content_type string")
    r = build_prompts(df).first()
    want = C.PROMPT_TEMPLATE.format(content_type="email", target_tokens=321,
                                    instruction=dict(C.TYPE_INSTRUCTIONS)["email"],
                                    content=text[: C.PROMPT_CONTENT_CHARS])
    assert r.prompt == want and r.max_tokens == 421
