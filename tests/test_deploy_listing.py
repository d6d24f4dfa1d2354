"""View deployment in dependency order, statement splitting, and the listing state of landed files."""
import os

import pytest

from lakestrata.plans.views import deploy_views, split_statements
from lakestrata.session import scratch_dir
from lakestrata.sources.landing import list_landed_files, take_unseen


def test_statements_end_only_at_real_semicolons():
    text = """SELECT 'a;b' AS x; -- not; here
    SELECT "c;d", `e;f` /* nor; here */ , 'it''s; one' FROM t;;
    SELECT 'back\\\\'; SELECT '\\'; still' """
    assert split_statements(text) == ["SELECT 'a;b' AS x", "SELECT \"c;d\", `e;f`   , 'it''s; one' FROM t", "SELECT 'back\\\\'", "SELECT '\\'; still'"]
    assert split_statements(" ; -- nothing\n;") == [] and split_statements("SELECT 1") == ["SELECT 1"]


def test_views_are_deployed_in_dependency_order(spark, tmp_path):
    for sub, name, body in (("a", "top", "SELECT x + 1 AS x FROM lakestrata_mid"), ("b", "mid", "SELECT x * 2 AS x FROM lakestrata_low"),
                            ("c", "low", "SELECT id AS x FROM range(3)")):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / f"{name}.sql").write_text(f"CREATE OR REPLACE VIEW lakestrata_{name} AS {body};")
    ran = deploy_views(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in ran] == ["low.sql", "mid.sql", "top.sql"]
    assert sorted(r.x for r in spark.table("lakestrata_top").collect()) == [1, 3, 5]
    (tmp_path / "a" / "loop.sql").write_text("CREATE OR REPLACE VIEW lakestrata_p AS SELECT * FROM lakestrata_q; CREATE VIEW lakestrata_q AS SELECT * FROM lakestrata_p")
    with pytest.raises(RuntimeError, match="lakestrata_q"):
        deploy_views(spark, str(tmp_path))


def test_rewritten_files_and_files_of_one_second_are_taken_once(spark, tmp_path):
    root = scratch_dir(spark, "t-seen")
    land = tmp_path / "land"
    land.mkdir()

    def put(name, text, at):
        (land / name).write_text(text)
        os.utime(land / name, (at, at))

    def take(run):
        return sorted(r["name"] for r in take_unseen(spark, list_landed_files(spark, str(land)), "lakestrata_seen", root, run).collect())

    put("a_1.csv", "x", 1000)
    put("b_1.csv", "x", 1000)
    assert take("r1") == ["a_1.csv", "b_1.csv"] and take("r2") == []
    put("a_1.csv", "xy", 1000)  # the same second, another length
    put("b_1.csv", "z", 2000)  # the same length, another time
    put("c_1.csv", "x", 1000)  # the second of files already taken
    assert take("r3") == ["a_1.csv", "b_1.csv", "c_1.csv"] == take("r3") and take("r4") == []
