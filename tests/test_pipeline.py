"""Sources, tiers, the data stages end to end, registry and streaming."""

import csv
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks import config as cfg
from siltworks.operators import judge, lineage, registry, tokenize
from siltworks.plans import pipeline
from siltworks.sources import files, readers, registry as registry_files, tensors, tiers

RUN = "run-20240102-030405-0a1b2c"


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    """A CSV of 100 rows and 20 JSON lines with known outcomes."""
    folder = tmp_path_factory.mktemp("inputs")
    clean = [(f"What about topic number {i}?", f"Topic {i} is well understood by now." + {2: " [[score=3]]", 13: " [[score=9]]", 30: " [[score=5]]", 61: " [[score=6]]"}.get(i, ""), "Be helpful." if i % 4 == 0 else "") for i in range(80)]
    rows = clean + [clean[i] for i in (0, 27, 55)] + [(f"q{i}", f"a{i}", "") for i in range(5)] + [("long " * 3500 + str(i), "answer " * 2300, "") for i in range(2)]
    rows += [(f"Can you mail person{i}@site.example about it?", f"Sure, case {i}, or call 646-555-014{i}.", "") for i in range(4)]
    rows += [(f"An unanswered question {i}", "", "") for i in range(3)] + [("", f"An answer to nothing {i}", "") for i in range(3)]
    with open(folder / "support.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["question", "answer", "system"])
        w.writerows(rows)
    turn = lambda role, text: {"role": role, "content": [{"type": "text", "value": text}]}
    lines = [{"conversation": [turn("system", "Be kind.")] * (i < 3) + [turn("user", f"Tell me of subject {i}, please"), turn("assistant", f"Subject {i} is fine." + " [[score=4]]" * (i == 1))]} for i in range(10)]
    lines += [{"prompt": f"Flat question number {i}", "response": f"Flat answer {i} with a separator" + " [[score=2]]" * (i == 2)} for i in range(5)] + [{"kind": i} for i in range(5)]
    (folder / "extra.jsonl").write_text("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in lines), encoding="utf-8")
    return folder


@pytest.fixture(scope="module")
def config(inputs):
    return cfg.parse({
        "model": {"adapter": "word"}, "judge": {"model": "marked"},
        "ingest": {"sources": [
            {"type": "csv", "uri": str(inputs / "support.csv"), "mapping": {"prompt_column": "question", "response_column": "answer", "system_column": "system"}},
            {"type": "jsonl", "uri": str(inputs / "extra.jsonl")},
        ]},
    })


@pytest.fixture(scope="module")
def root(spark, config, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tiers"))
    assert pipeline.run(spark, config, folder, RUN, judge.score_marked) == 0
    return folder


def manifest(spark, root, tier):
    return tiers.read_manifest(spark, root, tier, RUN)


def test_golden_counts(spark, root):
    drops = lambda t: {d["reason"]: d["count"] for d in manifest(spark, root, t)["drops"]}
    assert manifest(spark, root, "bronze")["counts"] == {"read": 120, "written": 120, "dropped": 0}
    assert manifest(spark, root, "silver")["counts"] == {"read": 120, "written": 99, "dropped": 21}
    assert drops("silver") == {"duplicate": 3, "too_long": 2, "too_short": 5, "unmappable": 11}
    assert manifest(spark, root, "gold")["counts"] == {"read": 99, "written": 94, "dropped": 5}
    assert drops("gold") == {"below_threshold": 5}


def test_order_lineage_and_conservation(spark, root):
    bronze, silver, gold = (tiers.read_tier(spark, root, t, RUN) for t in ("bronze", "silver", "gold"))
    locators = [r[0] for r in bronze.orderBy("seq").select("source.locator").collect()]
    assert locators == [f"row:{i}" for i in range(1, 101)] + [f"line:{i}" for i in range(1, 21)]
    order = {r["id"]: r["seq"] for r in bronze.collect()}
    kept = [order[r["id"]] for r in silver.orderBy("seq").select("id").collect()]
    assert kept == sorted(kept)
    texts = " ".join(p["value"] for r in silver.collect() for t in r["conversation"] for p in t["content"])
    assert "site.example" not in texts and "[EMAIL]" in texts and "[PHONE]" in texts and " " in texts
    exported = files.read_json(spark, pipeline.export_index_map(spark, root, RUN))
    ids = [e["record_id"] for s in ("train", "eval") for e in exported["splits"][s]] + [d["record_id"] for d in exported["dropped"]]
    assert sorted(ids) == sorted(r["id"] for r in gold.select("id").collect())
    for s in ("train", "eval"):
        assert [e["row"] for e in exported["splits"][s]] == list(range(len(exported["splits"][s])))
    rows = spark.createDataFrame([(json.dumps(manifest(spark, root, t)), tiers.manifest_uri(root, t, RUN)) for t in ("bronze", "silver", "gold")], "j string, uri string")
    from siltworks.schemas import MANIFEST_DDL

    chained = lineage.chain(rows.select(F.from_json("j", MANIFEST_DDL).alias("m"), "uri").select("m.*", "uri")).collect()
    assert len(chained) == 1 and chained[0]["conserved"]


def test_tensors(spark, root):
    rows = spark.read.parquet(f"{root}/artifacts/{RUN}/tensors").collect()
    exported = files.read_json(spark, pipeline.export_index_map(spark, root, RUN))
    for r in rows:
        arrays = tensors.decode(bytes(r["content"]))
        assert arrays["input_ids"].shape == arrays["labels"].shape == (len(exported["splits"][r["split"]]), arrays["labels"].shape[1])
        assert ((arrays["labels"] == tokenize.IGNORE) | (arrays["labels"] == arrays["input_ids"])).all()
        assert (arrays["labels"][arrays["attention_mask"] == 0] == tokenize.IGNORE).all()
        assert arrays["attention_mask"].sum(1).max() == arrays["labels"].shape[1]


def test_rerun_gives_equal_bytes_and_replaces(spark, config, root, tmp_path):
    first = manifest(spark, root, "silver")["records_hash"]
    other = str(tmp_path)
    pipeline.ingest(spark, config, other, RUN, shard_rows=50)
    assert manifest(spark, other, "bronze")["files"] == ["records-00000.jsonl", "records-00001.jsonl", "records-00002.jsonl"]
    assert [len(open(f"{other}/bronze/{RUN}/records-0000{i}.jsonl").readlines()) for i in range(3)] == [50, 50, 20]
    pipeline.clean(spark, config, other, RUN)
    assert tiers.read_tier(spark, other, "silver", RUN).count() == 99
    texts = lambda r: [x["conversation"] for x in tiers.read_tier(spark, r, "silver", RUN).orderBy("seq").collect()]
    assert texts(other) == texts(root) and first == manifest(spark, root, "silver")["records_hash"]
    pipeline.ingest(spark, config, other, RUN)
    assert files.listing(spark, f"{other}/bronze/{RUN}") == [n for n in files.listing(spark, f"{other}/bronze/{RUN}") if "00001" not in n and "00002" not in n]


def test_exit_codes(spark, config, tmp_path, inputs):
    root = str(tmp_path / "t")
    assert pipeline.stage_code(lambda: pipeline.clean(spark, config, root, RUN), "clean") == 2
    for name, text in {"broken": '{"a": 1}\n{"a": \n', "list": "[1]\n", "blank": '{"a":1}\n\n', "bytes": None}.items():
        path = tmp_path / f"{name}.jsonl"
        path.write_bytes(b'{"a": "\xff"}\n' if text is None else text.encode())
        bad = cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": [{"type": "jsonl", "uri": str(path)}]}})
        assert pipeline.run(spark, bad, root, RUN) == 2
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    none = cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": [{"type": "jsonl", "uri": str(empty)}]}})
    assert pipeline.run(spark, none, root, RUN) == 3
    assert not files.exists(spark, tiers.manifest_uri(root, "bronze", RUN))
    unknown = cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": [{"type": "pdf", "uri": "x"}]}})
    assert pipeline.run(spark, unknown, root, RUN) == 2
    wrong = cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": [{"type": "csv", "uri": str(inputs / "support.csv"), "mapping": {"prompt_column": "nope"}}]}})
    assert pipeline.run(spark, wrong, root, RUN) == 2


def test_csv_rows(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes('a,b\n" x ","two\nlines ""q"""\nshort\n\n1,\n'.encode())
    rows = readers.read_csv(spark, readers.Source("csv", str(path))).orderBy("n").collect()
    assert [json.loads(r["raw"]) for r in rows] == [{"a": " x ", "b": 'two\nlines "q"'}, {"a": "short", "b": None}, {"a": "1", "b": ""}]
    path.write_bytes(b"a,b\n1,2\n1,2,3\n")
    assert readers.first_error(readers.read_csv(spark, readers.Source("csv", str(path)))) == "record 2: more fields than the header"
    assert readers.first_error(readers.read_csv_split(spark, readers.Source("csv", str(path)))) == "record 2: more fields than the header"
    path.write_bytes(b'a,b\n1\n"1,2,3"\n1,"x, y"\n')
    assert readers.first_error(readers.read_csv_split(spark, readers.Source("csv", str(path)))) is None
    path.write_bytes(b"a,b\n1,\xff\n")
    assert readers.first_error(readers.read_csv(spark, readers.Source("csv", str(path))))


def test_ordinals_over_partitions(spark):
    frame = readers.with_ordinal(spark.range(0, 1000, 1, 7))
    assert all(r["n"] == r["id"] + 1 for r in frame.collect())


def test_ordinals_after_a_shuffle(spark):
    """Wide rows and their counts may be cut into other partitions by adaptive execution."""
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("seq"), F.repeat(F.col("id").cast("string"), 100).alias("wide"))
    dense = pipeline._dense(rows.withColumn("old", F.col("seq")))
    assert dense.where("seq != old").count() == 0 and dense.count() == 40_000
    split = rows.withColumn("split", F.when(F.col("seq") % 3 == 0, "eval").otherwise("train"))
    numbered = tokenize.with_row(split)
    assert numbered.where("row != case when split = 'eval' then seq div 3 else seq - seq div 3 - 1 end").count() == 0


def test_config_is_strict():
    base = {"model": {"adapter": "word"}, "ingest": {"sources": []}}
    assert cfg.parse(base).clean.max_chars == 32_000
    for bad in ({"extra": 1}, {"clean": {"min": 1}}, {"clean": {"pii": ["ssn"]}}, {"judge": {"threshold": 2}}, {"judge": {"max_concurrency": 0}}, {"tokenize": {"eval_fraction": "x"}}, {"train": {"method": "lora"}}, {"model": {}}):
        with pytest.raises(cfg.ConfigError):
            cfg.parse(base | bad)
    assert cfg.merge_hyperparameters({"lr": 1, "r": 8}, {"lr": 2}) == {"lr": 2, "r": 8}
    with pytest.raises(cfg.ConfigError):
        cfg.merge_hyperparameters({"lr": 1}, {"rl": 2})


def test_judge_rules(spark):
    frame = spark.createDataFrame([(i, s) for i, s in enumerate([5, 6, 7, 8, 9, 10, 10, 10, 10, None])], "seq long, score int")
    flagged = judge.promoted(frame)
    assert [r["score"] for r in flagged.where("drop_reason is null").orderBy("seq").collect()][:3] == [7, 8, 9]
    assert not judge.error_rate(flagged).first()["abort"]  # exactly a tenth
    assert judge.error_rate(judge.promoted(frame.withColumn("score", F.when(F.col("seq") > 5, F.col("score"))))).first()["abort"]
    assert judge.metrics(flagged.where("false")).first().asDict() == {"mean_score": 0.0, "median_score": 0.0, "promotion_rate": 0.0, "judge_error_rate": 0.0}
    assert [r["n"] for r in judge.histogram(flagged).orderBy("bin").collect()] == [0, 0, 0, 0, 0, 1, 1, 1, 1, 5]


def test_asking_retries():
    import random

    def run(*answers, retries=3):
        left, waits = list(answers), []
        out = judge.ask(lambda body: left.pop(0), "m", "p", retries, random.Random(1), waits.append)
        return out, len(waits)

    good = (200, {"choices": [{"message": {"content": '{"score": 8}'}}]})
    assert run(good) == ((8, ""), 0)
    assert run((429, None), (503, None), (None, None), good) == ((8, ""), 3)
    assert run((404, None), good) == (None, 0)
    assert run((200, {}), (200, {"choices": [{"message": {"content": None}}]}), good) == ((8, ""), 2)
    assert run(*[(500, None)] * 4) == (None, 3)
    assert all(judge.backoff(a, random.Random(a)) <= min(60, 2 * 2 ** (a - 1)) for a in range(1, 12))


def test_labels():
    words = tokenize.WordTokenizer()
    messages = [{"role": "system", "content": "s"}, {"role": "user", "content": "a b"}, {"role": "assistant", "content": "c d"}]
    ids, labels = tokenize.labels_of(messages, words)
    assert labels[:8] == [tokenize.IGNORE] * 8 and labels[8:] == ids[8:] and ids[-1] == words.END
    with pytest.raises(tokenize.MaskingMismatch):
        tokenize.labels_of(messages[2:], words)
    merging = lambda m, g: [sum(len(x["content"]) for x in m)]
    with pytest.raises(tokenize.MaskingMismatch):
        tokenize.labels_of(messages, merging)


def test_modality_and_length_drops(spark):
    from siltworks.schemas import CONVERSATION

    part = lambda kind, v: {"type": kind, "value": v}
    records = [[{"content": [part("image", "x")], "role": "user"}, {"content": [part("text", "y")], "role": "assistant"}], [{"content": [part("text", "q " * 9)], "role": "user"}, {"content": [part("text", "y")], "role": "assistant"}], [{"content": [part("text", "q")], "role": "user"}, {"content": [part("text", "y")], "role": "assistant"}]]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "seq long, j string").select("seq", F.from_json("j", CONVERSATION).alias("conversation"))
    got = [r["drop_reason"] for r in tokenize.tokenized(frame, tokenize.WordTokenizer, 6).orderBy("seq").collect()]
    assert got == ["unsupported_modality", "over_max_len", None]


def test_tensor_round_trip():
    arrays = {"a": np.arange(6).reshape(2, 3), "b": np.zeros((0, 0), np.int64)}
    back = tensors.decode(tensors.encode(arrays))
    assert all((back[k] == v).all() and back[k].shape == v.shape for k, v in arrays.items())


def test_registry(spark, config, tmp_path):
    root = str(tmp_path)
    assert registry.lines(registry_files.scan(spark, root)) == ["no models registered"] if files.listing(spark, f"{root}/registry") else True
    for i in range(3):
        pipeline.register(spark, config, root, f"run-2024010{i}-000000-00000{i}", "w", (1.0, 0.5), "t", "base")
    base = f"{root}/registry"
    good = registry_files.get(spark, base, "word-run-20240100-000000-000000")
    for name, text in {"bad1": "no json", "bad2": json.dumps(good | {"extra": 1}), "bad3": json.dumps(good | {"status": "old"}), "bad4": json.dumps({k: v for k, v in good.items() if k != "method"})}.items():
        files.write_bytes(spark, f"{base}/{name}/manifest.json", text.encode())
    files.write_bytes(spark, f"{base}/bad5/manifest.json", b'{"a": "\xff"}')
    found = registry_files.scan(spark, base)
    assert [r["key"] for r in registry.invalid_keys(found).collect()] == [f"bad{i}/manifest.json" for i in range(1, 6)]
    assert registry.newest(found).count() == 3 and registry.newest(found, "promoted").count() == 0 and registry.newest(found, "candidate", "word").count() == 3
    assert len(registry.lines(found)) == 9
    promoted = registry.promote(found.where("valid"), good["model_version"])
    assert [r["model_version"] for r in promoted.where("status = 'promoted'").collect()] == [good["model_version"]]
    with pytest.raises(KeyError):
        registry_files.get(spark, base, "none")


def test_train_and_smoke_hooks(spark, config, root):
    def trainer(spark, config, root, run_id):
        return {"weights_uri": f"{root}/w", "base_model": "b", "tracking_id": "t", "final_train_loss": 1.0, "final_eval_loss": 0.5}

    assert pipeline.stage_code(lambda: pipeline.smoke_test(spark, config, root, RUN, None, None), "smoke") == 2
    pipeline.train(spark, config, root, RUN, trainer)
    loader = lambda word: lambda: lambda messages: f"{word} {len(messages)}"
    transcript = pipeline.smoke_test(spark, config, root, RUN, loader("base"), loader("tuned"))
    index = files.read_json(spark, pipeline.export_index_map(spark, root, RUN))
    assert [s["record_id"] for s in transcript["samples"]] == [e["record_id"] for e in index["splits"]["eval"]][: config.smoke.num_prompts]
    assert all(s["tuned_output"].startswith("tuned ") and s["base_output"].startswith("base ") and s["reference"] for s in transcript["samples"])


def test_registry_tools(spark, config, tmp_path):
    import io

    from siltworks.plans import tools

    root = str(tmp_path)
    pipeline.register(spark, config, root, RUN, "w", (1.0, 0.5), "t", "base")
    ask = [
        {"id": 1, "method": "initialize"}, {"method": "notifications/initialized"}, {"id": 2, "method": "tools/list"}, {"id": 3, "method": "tools/call", "params": {"name": "list_models", "arguments": {"status": "candidate"}}},
        {"id": 4, "method": "tools/call", "params": {"name": "get_model", "arguments": {"model_version": f"word-{RUN}"}}}, {"id": 5, "method": "tools/call", "params": {"name": "get_model", "arguments": {"model_version": "x"}}}, {"id": 6, "method": "none"},
    ]
    out = io.StringIO()
    tools.serve(spark, f"{root}/registry", [json.dumps(a) for a in ask] + ["no json"], out)
    replies = [json.loads(x) for x in out.getvalue().splitlines()]
    assert [r["id"] for r in replies] == [1, 2, 3, 4, 5, 6, None]
    assert replies[2]["result"]["structuredContent"]["models"][0]["model_version"] == f"word-{RUN}"
    assert replies[3]["result"]["structuredContent"]["run_id"] == RUN and replies[4]["result"]["isError"] and "error" in replies[5]


def test_sql_functions(spark):
    from siltworks.functions.register import register

    register(spark)
    row = spark.sql("""SELECT scrub_pii('  a@b.de or 646-555-0142\u0000 ') AS s, assign_split('x', 1D) AS a, canonical_hash('{"b": 1, "a": 2}') AS h, parse_judge_reply('{"score": 3}').score AS p""").first()
    assert (row["s"], row["a"], row["p"]) == ("[EMAIL] or [PHONE]", "eval", 3) and row["h"].startswith("sha256:")


def test_stream(spark, inputs, tmp_path):
    from siltworks.streaming import clean as streaming

    stream = streaming.clean(streaming.read(spark, str(inputs / "*.jsonl")))
    query = stream.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("cleaned").count() == 15


def test_library_tokenizer(spark, tmp_path):
    import hashlib

    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    revision = hashlib.sha256(open(path, "rb").read()).hexdigest()
    made = tokenize.adapter("library", path, revision)()
    messages = [{"role": "user", "content": "hello there"}, {"role": "assistant", "content": "hi"}, {"role": "user", "content": "bye"}, {"role": "assistant", "content": "so long"}]
    ids, labels = tokenize.labels_of(messages, made)
    kept = [t for t in labels if t != tokenize.IGNORE]
    assert made.tokenizer.decode(kept, skip_special_tokens=True) == "hiso long" and kept.count(made.end) == 2
    assert tokenize.pad_id(made) == made.end
    with pytest.raises(tokenize.TokenizerError, match="pinned"):
        tokenize.adapter("library", path, "0")()
    (tmp_path / "broken.json").write_text("{}")
    for bad in (str(tmp_path / "none.json"), str(tmp_path / "broken.json")):
        with pytest.raises(tokenize.TokenizerError):
            tokenize.adapter("library", bad)()
    with pytest.raises(tokenize.TokenizerError):
        tokenize.adapter("library")


def test_tier_order_over_blocks(spark, tmp_path):
    """Lines keep their order when files are cut into blocks."""
    root = str(tmp_path)
    rows = spark.range(5000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), F.lit(RUN).alias("run_id"), F.lit(None).cast("string").alias("content_hash"), F.rpad(F.col("id").cast("string"), 300, "x").alias("raw"), F.col("id").alias("seq"))
    tiers.write_tier(rows, root, "bronze", RUN, "ingest", None, {}, (), 5000, 900)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = tiers.read_tier(spark, root, "bronze", RUN)
        assert got.rdd.getNumPartitions() > 8
        assert [r["id"] for r in got.orderBy("seq").select("id").collect()] == [f"r{i}" for i in range(5000)]
        assert [r["seq"] for r in got.orderBy("seq").select("seq").collect()] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cleaning_scrubs_once(spark):
    """Nothing before the deduplication is planned twice."""
    from siltworks.plans import queries

    import os

    folder = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    plan = queries.clean_documents(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("Relation") <= 2


def test_offline_judge_and_threads(spark):
    import random

    post = judge.stand_in()
    ask = lambda text, retries=2: judge.ask(post, "m", text, retries, random.Random(1), lambda s: None)
    assert ask("x") == (8, "marked") and ask("[[score=2]]") == (2, "marked") and ask("[[fail=500]]") is None and ask("[[garbage]]") is None
    assert ask("[[fail_once=500]] [[score=3]]") == (3, "marked") and ask("[[fail_once=500]] again", 0) is None and ask("[[fail_once=404]]") is None


def test_run_records(spark, tmp_path):
    from siltworks.sources import tracking

    root = str(tmp_path)
    with pytest.raises(KeyError):
        tracking.one(spark, root, "r", "judge")
    for n in (1.0, 2.0):
        tracking.log(spark, root, "r", "judge", {"n": n}, {"p": 1}, {"t": "x"}, {"a.txt": b"a"})
    found = tracking.one(spark, root, "r", "judge")
    assert found["metrics"] == {"n": 2.0} and found["params"] == {"p": "1"} and found["tags"] == {"t": "x", "run_id": "r", "stage": "judge"} and found["artifacts"] == ["a.txt"]
    with pytest.raises(KeyError):
        tracking.one(spark, root, "r", "train")
