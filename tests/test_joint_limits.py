import math

from pyspark.sql import functions as F

from episodeframe.operators import joint_limits as L
from episodeframe.sources.files import read_robot_joints


def test_limits_follow_names_not_places(spark, tmp_path):
    (tmp_path / "model=a").mkdir()
    (tmp_path / "model=a" / "robot.urdf").write_text("""<robot name="r"><link name="b"/>
      <joint name="j1" type="revolute"><parent link="b"/><child link="l"/><limit lower="-1" upper="1" effort="1" velocity="2"/></joint>
      <joint name="j2" type="revolute"><limit lower="0" upper="5"/></joint>
      <joint name="free" type="continuous"><parent link="b"/></joint></robot>""")
    joints = read_robot_joints(spark, str(tmp_path))
    got = {r.name: (r.model, r.parent, r.lower, r.upper, r.velocity) for r in joints.collect()}
    assert got == {"j1": ("a", "b", -1.0, 1.0, 2.0), "j2": ("a", None, 0.0, 5.0, None), "free": ("a", "b", None, None, None)}
    maps = L.limit_maps(joints.unionByName(joints.where("name = 'j1'").withColumn("upper", F.lit(0.5))))
    nan = float("nan")
    df = spark.createDataFrame([(1, "a", ["j2", "j1"], [6.0, 0.75]), (2, "a", ["free", "x", "j1"], [99.0, 99.0, None]), (3, "a", ["j1"], [nan]),
                                (4, "b", ["j1"], [9.0]), (5, "a", [], []), (6, "a", ["j1", "j2"], [-3.0])],
                               "id int, model string, names array<string>, v array<double>")
    bad = sorted((r.id, r.pos, r.joint, r.value, r.lower, r.upper) for r in L.violations(df, maps, "names", "v", ["id"]).collect())
    assert [b for b in bad if not math.isnan(b[3])] == [(1, 0, "j2", 6.0, 0.0, 5.0), (1, 1, "j1", 0.75, -1.0, 0.5), (6, 0, "j1", -3.0, -1.0, 0.5)]
    assert {(r.model, r.joint, r.n) for r in L.unknown_joints(df, maps, "names", "v").collect()} == {("a", "x", 1), ("b", "j1", 1)}
    c = {r.id: list(r.c) for r in L.clamped(df, maps, "names", "v", "c").collect()}
    assert c[1] == [5.0, 0.5] and c[2] == [99.0, 99.0, None] and math.isnan(c[3][0]) and c[4] == [9.0] and c[5] == [] and c[6] == [-1.0, None]
