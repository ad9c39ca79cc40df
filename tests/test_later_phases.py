"""Registry transitions, media checks, vetoes, regression numbers, grants and training order on odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from siltworks.operators import assets, grants, judge, order, registry, smoke
from siltworks.plans import pipeline
from siltworks.sources import files, registry as registry_files

VERSIONS = "model_version string, adapter_name string, status string, weights boolean, retired_at string"
REQUESTS = "adapter_name string, at string, seq long, op string, model_version string, by string"


def folded(versions, requests):
    """Outcomes and states by a fold over the requests."""
    state = {(a, v): [s, None, []] for v, a, s, _, _ in versions}
    weights = {(a, v): w for v, a, _, w, _ in versions}
    now, retired = {}, {}
    for v, a, s, _, at in versions:
        if s == "promoted":
            now[a] = v
        if s == "retired":
            retired[a] = max(retired.get(a, ("", "")), (at, v))
    last = {a: v for a, (_, v) in retired.items() if a in now}
    out = {}
    for a, at, seq, op, v, by in sorted(requests, key=lambda r: (r[1], r[2])):
        if op == "promote":
            refused = "unknown version" if (a, v) not in state else "no candidate" if state[a, v][0] != "candidate" else "missing weights" if not weights[a, v] else None
            up = v
        else:
            refused, up = (None if a in last else "nothing to roll back to"), last.get(a)
        if refused:
            out[seq] = (refused, None, None)
            continue
        down = now.get(a)
        out[seq] = (None, up, down)
        state[a, up][2].append((at, state[a, up][0], "promoted", by))
        state[a, up][:2] = ["promoted", None]
        if down:
            state[a, down][2].append((at, "promoted", "retired", by))
            state[a, down][:2] = ["retired", up]
            last[a] = down
        now[a] = up
        assert sum(s == "promoted" for (x, _), (s, _, _) in state.items() if x == a) <= 1
    return out, {k: tuple(v) for k, v in state.items()}


@pytest.mark.parametrize("seed", range(3))
def test_transitions_are_a_fold(spark, seed):
    rng = random.Random(seed)
    versions = [(f"v{i}", a, "candidate", rng.random() < 0.8, None) for a in "xyz" for i in range(12)]
    versions += [("p", "x", "promoted", True, None), ("r1", "x", "retired", True, "2024-01-01"), ("r2", "x", "retired", True, "2024-01-02"), ("p", "y", "promoted", True, None)]
    requests = []
    for seq in range(120):
        adapter = "x" if rng.random() < 0.6 else rng.choice("yz")
        op = rng.choice(["promote", "promote", "rollback"])
        requests.append((adapter, f"2024-02-{rng.randint(1, 9):02d}", seq, op, f"v{rng.randrange(14)}" if op == "promote" else None, "me"))
    outcomes, states = folded(versions, requests)
    held = spark.createDataFrame(versions, VERSIONS)
    found = registry.judged(held, spark.createDataFrame(requests, REQUESTS)).cache()
    assert {r["seq"]: (r["refused"], r["gone_up"], r["gone_down"] if r["refused"] is None else None) for r in found.collect()} == outcomes
    got = {(r["adapter_name"], r["model_version"]): (r["status"], r["superseded_by"], [tuple(h) for h in r["history"]]) for r in registry.after(held, found).collect()}
    # histories start with the requests; superseded_by of versions retired before is not given here
    assert got == states
    found.unpersist()


def test_no_requests_and_odd_ones(spark):
    held = spark.createDataFrame([("v", "a", "candidate", True, None)], VERSIONS)
    none = registry.judged(held, spark.createDataFrame([], REQUESTS))
    assert none.count() == 0
    assert registry.after(held, none).first()["status"] == "candidate"
    odd = registry.judged(held, spark.createDataFrame([("a", None, 1, "rename", "v", None), (None, "t", 2, "rollback", None, None), ("a", "t", 3, "promote", None, None)], REQUESTS))
    assert {r["seq"]: r["refused"] for r in odd.collect()} == {1: "unknown operation", 2: "nothing to roll back to", 3: "unknown version"}


def test_registry_files(spark, tmp_path, capsys):
    """Two candidates: promote the second, then the first, then roll back; then lose the weights."""
    root = str(tmp_path / "registry")
    for v in ("a", "b"):
        files.write_bytes(spark, f"{tmp_path}/weights-{v}", b"w")
        registry_files.put(spark, root, {
            "model_version": v, "run_id": "r", "adapter_name": "word", "base_model": "b", "method": "full", "created_at": "2024-01-01T00:00:00Z", "gold_manifest_uri": "g", "index_map_uri": "i",
            "weights_uri": f"{tmp_path}/weights-{v}", "mlflow_run_id": "t", "hyperparameters": {}, "eval": {"final_train_loss": 1.0, "final_eval_loss": 0.5}, "status": "candidate",
        })
    status = lambda: {r["model_version"]: (r["status"], r["superseded_by"], r["valid"]) for r in registry_files.scan(spark, root).collect()}
    assert pipeline.registry_code(spark, root, "rollback", "word", "me") == 2
    assert registry_files.change(spark, root, "promote", "b", "me") == ["b"]
    assert status() == {"a": ("candidate", None, True), "b": ("promoted", None, True)}
    assert registry_files.change(spark, root, "promote", "a", "me") == ["a", "b"]
    assert status() == {"a": ("promoted", None, True), "b": ("retired", "a", True)}
    assert registry_files.change(spark, root, "rollback", None, "you", "word") == ["a", "b"]
    assert status() == {"a": ("retired", "b", True), "b": ("promoted", None, True)}
    assert [(h["from"], h["to"], h["by"]) for h in registry_files.show(spark, root, "b")["history"]] == [("candidate", "promoted", "me"), ("promoted", "retired", "me"), ("retired", "promoted", "you")]
    for operation, target in (("promote", "a"), ("promote", "none"), ("show", "none"), ("show", None)):
        assert pipeline.registry_code(spark, root, operation, target, "me") == 2
    files.delete(spark, f"{tmp_path}/weights-b")
    assert pipeline.registry_code(spark, root, "show", "b", "me") == 2
    assert pipeline.registry_code(spark, root, "list", None, "me") == 0
    assert "retired" in capsys.readouterr().out


def record(seq, *parts, reason=None):
    return seq, [([*map(lambda p: p, parts)], "user")], reason


def test_assets(spark, tmp_path):
    root = tmp_path / "media"
    (root / "deep").mkdir(parents=True)
    (root / "ok.png").write_bytes(b"x" * 10)
    (root / "big.png").write_bytes(b"x" * 11)
    (root / "deep" / "a b.JPG").write_bytes(b"x")
    (root / "none").write_bytes(b"x")
    found = assets.listing(spark, str(root))
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    uri = lambda n: f"{root}/{n}"
    rows = [record(1, ("text", "t"), ("image", uri("ok.png"))), record(2, ("image", uri("big.png"))), record(3, ("image", uri("deep/a b.JPG"))), record(4, ("audio", uri("none"))), record(5, ("image", uri("gone.png"))),
            record(6, ("image", None)), record(7, ("text", "t")), record(8, ("image", uri("gone.png")), reason="too_short"), record(9, ("image", uri("ok.png")), ("image", uri("ok.png")), ("image", uri("big.png")))]
    rows += [record(100 + i, ("image", uri("gone.png" if i % 2 else "ok.png"))) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, conversation array<struct<content:array<struct<type:string,value:string>>,role:string>>, drop_reason string").withColumn("_hit0", F.lit("mine"))
    got = {r["seq"]: r["drop_reason"] for r in assets.tested(df, found, ("png", "jpg"), 10).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {1: None, 2: "bad_asset", 3: None, 4: "bad_asset", 5: "bad_asset", 6: "bad_asset", 7: None, 8: "too_short", 9: "bad_asset"}
    assert all((got[100 + i] == "bad_asset") == (i % 2 == 1) for i in range(300))
    assert assets.tested(df.limit(0), found, ("png",), 1).count() == 0


def test_vetoes(spark):
    rows = spark.createDataFrame([(str(i), 9, "r") for i in range(6)] + [("6", None, None), ("7", 2, "r")], "id string, score int, reasoning string")
    found = spark.createDataFrame([("0", "image", 0.1), ("1", "image", 0.2), ("2", "audio", 0.0), ("3", "image", None), ("4", "image", 0.9), ("4", "image", 0.1), ("6", "image", 0.1), ("none", "image", 0.1)], "id string, modality string, score double")
    got = {r["id"]: (r["drop_reason"], r["modality_scores"]) for r in judge.with_modality(rows, found, {"image": 0.2}).collect()}
    assert got == {"0": ("vetoed", {"image": 0.1}), "1": (None, {"image": 0.2}), "2": (None, {"audio": 0.0}), "3": (None, {}), "4": ("vetoed", {"image": 0.1}), "5": (None, {}), "6": ("vetoed", {"image": 0.1}), "7": ("below_threshold", {})}
    old = rows.withColumn("evaluation", F.expr("named_struct('modality_scores', map('image', 0.05D, 'video', 0.7D))"))
    got = {r["id"]: r["modality_scores"] for r in judge.with_modality(old, found, {}).collect()}
    assert got["1"] == {"image": 0.2, "video": 0.7} and got["5"] == {"image": 0.05, "video": 0.7}


def test_regression_with_ties(spark):
    samples = spark.createDataFrame([("a", "x y", "X  z"), ("a", "", " "), ("b", "x", "x"), ("c", None, "w")], "model_version string, tuned_output string, reference string")
    versions = spark.createDataFrame([("a", "m", "1"), ("b", "m", "2"), ("c", "m", "3"), ("d", "m", "3"), ("e", "other", "9")], "model_version string, adapter_name string, created_at string")
    promotions = spark.createDataFrame([("m", "1", "a"), ("m", "2", "b"), ("m", "2", "a"), ("m", "3", "c")], "adapter_name string, at string, model_version string")
    got = {r["model_version"]: (r["n"], r["score"], r["baseline"], r["baseline_score"], r["change"]) for r in smoke.regression(samples, versions, promotions).collect()}
    assert got == {"a": (2, 750, None, None, None), "b": (1, 1000, "a", 750, 250), "c": (1, 0, "b", 1000, -1000), "d": (0, None, "b", 1000, None), "e": (0, None, None, None, None)}


def test_grants_by_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    path = lambda n: "/".join(rng.choice("ab") for _ in range(n))
    held = [(rng.choice(["p", "q", "*"]), rng.choice(["", "/", "/x/"]) * (rng.random() < 0.1) + path(rng.randint(0, 4)), rng.choice(["R", "W", "-", "R", "odd", None])) for _ in range(60)]
    asked = [(rng.choice(["p", "q", "s", None]), rng.choice(["read", "write", "list", None]), rng.choice([None, "", "a//b/", path(rng.randint(1, 6))])) for _ in range(300)] + [("p", "read", "hot/a")] * 200

    def level(who, where):
        steps = [s for s in (where or "").split("/") if s]
        best = []
        for g, p, lv in held:
            at = [s for s in p.split("/") if s]
            if lv in ("-", "R", "W") and (g == "*" or g == who) and steps[: len(at)] == at:
                best.append((len(at), g != "*", -"-RW".index(lv), lv))
        return max(best)[-1] if best else "-"

    want = sorted((str(w), str(a), str(p), lv := level(w, p), lv == "W" and a in ("read", "write") or lv == "R" and a == "read") for w, a, p in asked)
    for bound in (grants.BROADCAST_GRANTS, 0):
        monkeypatch.setattr(grants, "BROADCAST_GRANTS", bound)
        out = grants.decided(spark.createDataFrame(asked, "principal string, action string, path string"), spark.createDataFrame(held, "principal string, path string, level string"))
        assert sorted((str(r["principal"]), str(r["action"]), str(r["path"]), r["level"], r["allowed"]) for r in out.collect()) == want
    observed = spark.createDataFrame([("p", "write", "none/of/it", True), ("s", "list", None, False)], "principal string, action string, path string, granted boolean")
    assert [r["path"] for r in grants.mismatches(observed, spark.createDataFrame([], "principal string, path string, level string")).collect()] == ["none/of/it"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 31, 64, 1000])
def test_training_order_is_a_permutation(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "row")
    got = [(r["epoch"], r["step"] * 10 + r["slot"], r["row"], r["slot"]) for r in order.scheduled(rows, n, 2, 10).collect()]
    for epoch in range(2):
        mine = [x for x in got if x[0] == epoch]
        assert sorted(x[1] for x in mine) == sorted(x[2] for x in mine) == list(range(n))
        assert all(x[3] < 10 for x in mine)
    if n == 1000:
        first, second = ([x[1] for x in sorted(got, key=lambda x: x[2]) if x[0] == e] for e in range(2))
        assert first != second
        moved = sum(abs(a - b) for a, b in enumerate(first)) / n
        assert 250 < moved < 420  # a random permutation moves a row by a third of n
        assert abs(sum((a - 499.5) * (b - 499.5) for a, b in enumerate(first)) / n / 83333) < 0.15
    assert "Exchange" not in order.scheduled(rows, n, 2, 10)._jdf.queryExecution().executedPlan().toString()


def test_training_order_bounds(spark):
    with pytest.raises(ValueError, match="rows"):
        order.place(F.col("row"), 1 << 32, 1, 0)
    with pytest.raises(ValueError, match="batch"):
        order.scheduled(spark.range(1), 1, 1, 0)
    assert order.scheduled(spark.range(3).withColumnRenamed("id", "row"), 3, 0, 1).count() == 0
