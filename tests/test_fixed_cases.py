"""Cases that need no table: source types, drop reasons, run identifiers, exit codes of stages, a trained version, padding."""

from pyspark.sql import functions as F

from siltworks import config as cfg, schemas
from siltworks.functions import hashing
from siltworks.operators import tokenize
from siltworks.plans import pipeline
from siltworks.sources import files, readers, registry, tiers, tracking

RUN = "run-20240101-000000-abcdef"


def test_source_types(spark, tmp_path):
    def known(kind):
        try:
            readers.read(spark, readers.Source(kind, f"{tmp_path}/none"))
        except readers.SourceError as e:
            return "unknown source type" not in str(e)
        except Exception:  # a reader that finds no file
            return True
        return True

    assert {k: known(k) for k in schemas.SOURCE_TYPES} == {"csv": True, "jsonl": True, "sql": True, "pdf": False, "api": False}


def test_a_manifest_refuses_unknown_reasons():
    def allowed(reason):
        try:
            tiers.make_manifest("silver", RUN, "clean", "up", [], "h", 1, 0, {reason: 1}, schemas.CLEAN_REASONS)
        except ValueError:
            return False
        return True

    assert all(map(allowed, schemas.CLEAN_REASONS)) and not allowed("judge_error") and not allowed("odd")


def test_stamps(spark):
    made = spark.createDataFrame([(hashing.new_run_id(), hashing.utc_now())], "run_id string, now string")
    assert made.select(schemas.is_run_id(F.col("run_id")) & schemas.is_utc(F.col("now"))).first()[0]


def test_stage_codes(spark, tmp_path):
    base = {"model": {"adapter": "word"}, "ingest": {"sources": []}}
    config, root = cfg.parse(base), str(tmp_path / "codes")

    def bug():
        raise RuntimeError("a bug")

    cases = {
        0: [lambda: cfg.parse(base), lambda: cfg.merge_hyperparameters({"lr": 1}, {"lr": 2})],
        2: [
            lambda: cfg.parse(base | {"clean": {"min": 1}}), lambda: cfg.parse(base | {"more": {}}), lambda: cfg.parse(base | {"tokenize": {"eval_fraction": "x"}}), lambda: cfg.parse(base | {"clean": {"pii": ["ssn"]}}),
            lambda: cfg.parse(base | {"judge": {"threshold": 2}}), lambda: cfg.merge_hyperparameters({"lr": 1}, {"rate": 2}), lambda: tokenize.adapter("none"), lambda: tokenize.adapter("library", f"{root}/none.json")(),
            lambda: pipeline.clean(spark, config, root, RUN),
        ],
        3: [lambda: pipeline.ingest(spark, config, root, RUN)],
        1: [bug],
    }
    assert {code: [pipeline.stage_code(f, "case") for f in fs] for code, fs in cases.items()} == {code: [code] * len(fs) for code, fs in cases.items()}


def test_a_trained_version(spark, tmp_path):
    root, config = str(tmp_path / "trained"), cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": []}})
    files.write_json(spark, f"{root}/artifacts/{RUN}/index_map.json", {"adapter": "word"})
    made = {"weights_uri": "weights", "base_model": "b", "tracking_id": "t", "final_train_loss": 2.0, "final_eval_loss": 0.5}
    pipeline.train(spark, config, root, RUN, lambda *a: made)
    assert tracking.one(spark, root, RUN, "train")["metrics"]["final_train_loss"] == 2.0
    found = registry.scan(spark, f"{root}/registry").where("valid").first()
    assert (found["model_version"], found["adapter_name"], found["weights_uri"], found["status"]) == (f"word-{RUN}", "word", "weights", "candidate")
    assert found["gold_manifest_uri"].endswith(f"/gold/{RUN}/manifest.json") and found["index_map_uri"].endswith(f"/artifacts/{RUN}/index_map.json")


def test_padding():
    stub = lambda **have: type("Stub", (), have)()
    assert [tokenize.pad_id(t) for t in (tokenize.WordTokenizer(), stub(pad=7, end=9), stub(pad=None, end=9), stub())] == [4, 7, 9, 0]


def test_stages_of_many_runs_stop_at_every_gate(spark):
    import json

    from siltworks.plans.file_queries import stage_codes

    plain = {"model": {"adapter": "word"}, "ingest": {"sources": []}, "train": {"hyperparameters": {"lr": 1}}}
    cases = {
        "plain": ({}, None, True, 1, None, 0), "override": ({}, {"lr": 2}, True, 1, None, 0), "no JSON": (None, None, True, 1, "config", 2), "unknown section": ({"more": {}}, None, True, 1, "config", 2),
        "wrong type": ({"tokenize": {"eval_fraction": "x"}}, None, True, 1, "config", 2), "hyperparameter": ({}, {"rate": 2}, True, 1, "hyperparameters", 2),
        "adapter": ({"model": {"adapter": "none"}}, None, True, 1, "adapter", 2), "tokenizer": ({"model": {"adapter": "library", "tokenizer": "/none.json"}}, None, True, 1, "tokenizer", 2),
        "upstream": ({}, None, False, 1, "upstream", 2), "unknown upstream": ({}, None, None, 1, "upstream", 2), "empty": ({}, None, True, 0, "records", 3), "bug": ({}, None, True, 1, "work", 1),
    }
    rows = [(k, "{" if c is None else json.dumps(plain | c), o and json.dumps(o), up, n) for k, (c, o, up, n, *_) in cases.items()]

    def work(config, run_id):
        if run_id == "bug":
            raise RuntimeError("a bug")

    found = pipeline.outcomes(spark.createDataFrame(rows, "run_id string, config string, overrides string, upstream boolean, records long"), work)
    assert {r["run_id"]: (r["gate"], r["code"]) for r in found.collect()} == {k: c[4:] for k, c in cases.items()}
    # the query's runs reach all of them
    kinds = stage_codes(spark, "/root/testdata/sf0.001").select("gate", "code").distinct().collect()
    assert {tuple(r) for r in kinds} == {(None, 0), ("config", 2), ("hyperparameters", 2), ("adapter", 2), ("tokenizer", 2), ("upstream", 2), ("records", 3), ("work", 1)}


def test_many_trained_versions(spark, tmp_path):
    root = str(tmp_path / "many")
    rows = [("run-20240101-000000-00000a", "word", "word"), ("run-20240101-000000-00000b", "word", "byte"), ("run-20240101-000000-00000c", "word", None), ("run-20240101-000000-00000d", "byte", "byte")]
    runs = spark.createDataFrame(rows, "run_id string, adapter_name string, index_adapter string")

    def trainer(gated):
        return gated.withColumns({"weights_uri": F.lit("w"), "base_model": F.lit("b"), "tracking_id": F.lit("t"), "final_train_loss": F.lit(2.0), "final_eval_loss": F.lit(0.5)})

    refused = {r["run_id"][-1]: r["refused"] for r in pipeline.train_many(runs, root, trainer).collect()}
    assert refused == {"a": None, "b": "tokenized with adapter byte, configured word", "c": "no tokenized artifact", "d": None}
    found = registry.scan(spark, f"{root}/registry").where("valid")
    assert sorted(r["model_version"] for r in found.collect()) == ["byte-" + rows[3][0], "word-" + rows[0][0]]
    assert tracking.one(spark, root, rows[0][0], "train")["metrics"] == {"final_train_loss": 2.0, "final_eval_loss": 0.5}
    # what is written last counts, in a batch or by itself
    name = "word-" + rows[0][0]
    made = registry.get(spark, f"{root}/registry", name)
    assert made["weights_uri"] == "w" and made["eval"]["final_eval_loss"] == 0.5
    registry.put(spark, f"{root}/registry", made | {"weights_uri": "v"})
    assert registry.get(spark, f"{root}/registry", name)["weights_uri"] == "v" and found.count() == 2
    pipeline.train_many(runs.limit(1), root, trainer)
    assert registry.get(spark, f"{root}/registry", name)["weights_uri"] == "w"


def test_a_query_reads_trained_versions_back(spark):
    from siltworks.plans.file_queries import trained_version

    assert {"adapter_name", "weights_uri", "final_eval_loss", "logged"} <= set(trained_version(spark, "/root/testdata/sf0.001").columns)
