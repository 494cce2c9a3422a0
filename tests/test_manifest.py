import pytest

from arrivals_mart.contracts import MART
from arrivals_mart.plans import read_inputs, run_pipeline
from arrivals_mart.sinks import expire_manifests, expire_versions, manifests, open_set, publish_manifest, read_manifest
from arrivals_mart.sinks import manifest as M
from fixtures import ARRIVALS, arrival, write_inputs


def test_a_reader_sees_one_run_between_any_two_steps(spark, tmp_dir, monkeypatch):
    """The second run has other rows in several tables; whatever step of its writes and publish
    a reader falls between, it sees all of the first run or all of the second."""
    out = f"{tmp_dir}/out"
    first = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/a"))
    with pytest.raises(FileNotFoundError):
        open_set(spark, out)
    run_pipeline(spark, first, out, publish_views=False)
    rows = [*ARRIVALS, arrival(500.0, visa=7.0, mode=4.0)]
    second = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/b", arrivals=rows))
    seen = []

    def look():
        found = open_set(spark, out)
        seen.append((found["immig_fact"].count(), found["visa_type_dim"].count()))

    from arrivals_mart.plans import pipeline

    checked, steps = pipeline.check_report, M.hadoop_path

    def after_writes(report):
        look()  # all tables of the second run are written
        return checked(report)

    def between(spark, path):
        if not path.endswith("/manifests") and not seen[-1] is None:
            steps_left.append(path)
        return steps(spark, path)

    steps_left = []
    monkeypatch.setattr(pipeline, "check_report", after_writes)
    monkeypatch.setattr(M, "hadoop_path", between)
    run_pipeline(spark, second, out, publish_views=False)
    look()
    assert seen[0][0] == len(ARRIVALS) and seen[1][0] == len(rows) and seen[0][1] < seen[1][1]
    assert len(steps_left) == 2  # the temporary name and the final one


def test_an_unfinished_manifest_is_not_read(spark, tmp_dir, monkeypatch):
    publish_manifest(spark, tmp_dir, {"a": "x"})
    whole = M.hadoop_path

    class Lost:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *a: False) if name == "rename" else getattr(self.fs, name)

    monkeypatch.setattr(M, "hadoop_path", lambda s, p: (Lost(whole(s, p)[0]), whole(s, p)[1]))
    with pytest.raises(OSError):
        publish_manifest(spark, tmp_dir, {"a": "y"})
    assert len(manifests(spark, tmp_dir)) == 1 and read_manifest(spark, tmp_dir).paths == {"a": "x"}


def test_manifests_sort_by_time_and_expire(spark, tmp_dir, monkeypatch):
    names = [publish_manifest(spark, tmp_dir, {"a": f"a{i}", "b": "b"}).name for i in range(3)]
    monkeypatch.setattr(M.time, "time", lambda: 5.0)  # a publisher whose clock is behind
    names.append(publish_manifest(spark, tmp_dir, {"a": "a3", "b": "b"}).name)
    assert manifests(spark, tmp_dir) == names == sorted(names)
    assert read_manifest(spark, tmp_dir).paths["a"] == "a3"
    assert read_manifest(spark, tmp_dir, names[0]).paths["a"] == "a0"
    assert expire_manifests(spark, tmp_dir, keep=2) == ["a0", "a1"]
    assert manifests(spark, tmp_dir) == names[2:]
    with pytest.raises(ValueError):
        expire_manifests(spark, tmp_dir, keep=0)


def test_versions_of_the_manifest_are_not_expired(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    results = [run_pipeline(spark, inputs, out, publish_views=False, manifest=i == 0) for i in range(3)]
    spare = read_manifest(spark, out).paths.values()
    for c in MART:
        assert expire_versions(spark, out, c.name, keep=1, spare=spare) == [results[1].paths[c.name]]
    assert {n: df.count() > 0 for n, df in open_set(spark, out).items()} == dict.fromkeys(results[0].paths, True)
