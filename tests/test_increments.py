"""Loads added and withdrawn, and frames that follow, equal the work done anew."""

import os
import random
import shutil

import pytest
from helpers import rows, statements

from ldspark.operators import increments as inc
from ldspark.operators.framing import RESERVED, frame_documents, store_by_type
from ldspark.operators.reducing import node_values, reduce_documents, union_all
from ldspark.operators.versions import Conflict
from ldspark.plans import Frame, RDF_TYPE

FRAME = Frame("P", {"of": Frame("C", {"in": Frame("R", keep=("name",))})})
BACK = Frame("R", {"has": Frame("P")})


def entity(uri, cls, *values):
    return [(uri, RDF_TYPE, cls, "type"), *[(uri, p, o, kind) for p, o, kind in values]]


def load(rng, n=6):
    """People of countries in regions, with dangling links, two types, a cycle and values of odd characters."""
    out = []
    for _ in range(n):
        i, j, k = rng.randrange(8), rng.randrange(4), rng.randrange(3)
        out += entity(f"p{i}", rng.choice(["P", "P", "Q"]), ("name", rng.choice(["é\t1", "b\n\"", "\U0001f600"]), "literal"), ("of", f"c{j}", "iri"))
        out += entity(f"c{j}", "C", ("in", f"r{rng.choice([k, 9])}", "iri"))
        out += entity(f"r{k}", rng.choice(["R", "C"]), ("name", rng.choice("xyz"), "literal"), ("has", f"p{i}", "iri"))
    return out


def flat(nodes):
    types = nodes.selectExpr("uri", "part", "'type'", "'type'", "explode(types)")
    return rows(node_values(nodes)) + rows(types)


def framed_rows(df):
    return sorted(str(r.asDict(recursive=True)) for r in df.collect())


def anew(spark, loads):
    if not loads:
        return spark.createDataFrame([], inc.NODES)
    return reduce_documents(union_all(*[statements(spark, x) for x in loads]))


@pytest.mark.parametrize("seed", [2])
def test_any_order_of_loads_equals_full_reduce_and_full_frames(spark, tmp_path, seed):
    rng = random.Random(seed)
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=3)
    frames = {"people": FRAME, "regions": BACK}
    framed, loads = None, {}
    for step in range(4):
        name = rng.choice("abc")
        if name not in loads:
            loads[name] = load(rng)
            collection = inc.add_load(collection, name, statements(spark, loads[name]))
        elif rng.random() < 0.5:
            del loads[name]
            collection = inc.withdraw_load(collection, name)
        else:
            loads[name] = loads[name][2:] + load(rng, 1)
            collection = inc.replace_load(collection, name, statements(spark, loads[name]))
        full = anew(spark, list(loads.values()))
        assert flat(collection.read_documents()) == flat(full)
        if framed is None:
            framed = inc.create_framed(collection, str(tmp_path / "f"), frames, merge_limit=2, buckets=3)
        elif step % 2:
            framed = inc.refresh_framed(inc.open_framed(spark, framed.path), collection)
        else:
            continue
        by_type = store_by_type(full, {"P", "C", "R"})
        for key, frame in frames.items():
            assert framed_rows(framed.read(key)) == framed_rows(frame_documents(by_type, frame, merge_limit=2))


def test_counts_keep_what_another_load_states(spark, tmp_path):
    both = entity("c1", "C", ("name", "x", "literal"))
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=2)
    collection = inc.add_load(collection, "a", statements(spark, both + both + entity("c1", "C", ("name", "y", "literal"))))
    collection = inc.add_load(collection, "b", statements(spark, both))
    assert {(r.o, r.n) for r in collection.read_statements().collect()} == {("C", 2), ("x", 2), ("y", 1)}
    collection = inc.withdraw_load(collection, "a")
    (node,) = collection.read_documents().collect()
    assert [x.v for x in node.props["name"]] == ["x"]
    empty = inc.withdraw_load(collection, "b")
    assert empty.read_documents().isEmpty() and empty.read_statements().isEmpty() and empty.loads == {}
    with pytest.raises(KeyError):
        inc.withdraw_load(empty, "b")
    with pytest.raises(ValueError):
        inc.add_load(collection, "b", statements(spark, both))


def test_several_loads_in_one_step(spark, tmp_path):
    a, b = entity("c1", "C", ("name", "x", "literal")), entity("c1", "C", ("name", "y", "literal"))
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=2)
    both = inc.add_loads(collection, {"a": statements(spark, a), "b": statements(spark, b)})
    assert both.version == collection.version + 1 and inc.add_loads(both, {}) is both
    assert {(r.o, r.n) for r in both.read_statements().collect()} == {("C", 2), ("x", 1), ("y", 1)}
    assert flat(inc.withdraw_load(both, "a").read_documents()) == flat(anew(spark, [b]))


def test_settings_of_the_reduce_are_kept(spark, tmp_path):
    loads = [entity("c1", "C", ("n", str(n), "literal"), ("m", str(n), "literal")) for n in (9, 10, 1)]
    rule = {"n": ("max", "int")}
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=2, values_per_row=2, single_valued=rule)
    for k, some in enumerate(loads):
        collection = inc.add_load(inc.open_collection(spark, collection.path), str(k), statements(spark, some))
    full = reduce_documents(*[statements(spark, x) for x in loads], single_valued=rule, values_per_row=2)
    assert flat(collection.read_documents()) == flat(full)
    without = inc.withdraw_load(collection, "1")
    kept = reduce_documents(statements(spark, loads[0]), statements(spark, loads[2]), single_valued=rule, values_per_row=2)
    assert flat(without.read_documents()) == flat(kept)


def test_only_changed_subjects_are_built_and_other_buckets_keep_their_files(spark, tmp_path):
    many = [s for i in range(60) for s in entity(f"c{i}", "C", ("name", f"n{i}", "literal"))]
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=16)
    first = inc.add_load(collection, "a", statements(spark, many))
    same = inc.add_load(first, "b", statements(spark, many[:6]))
    assert same.documents.folders == first.documents.folders, "nothing that is stated already makes a new document"
    one = inc.add_load(same, "d", statements(spark, entity("c7", "C", ("name", "other", "literal"))))
    assert rows(spark.read.parquet(f"{one.path}/{one.changes}")) == [("c7",)]
    changed = {b for b, f in one.documents.folders.items() if first.documents.folders[b] != f}
    assert len(changed) == 1
    assert flat(first.read_documents()) != flat(one.read_documents()), "an open version stays as it was"


def test_one_of_two_writers_wins(spark, tmp_path):
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=2)
    mine = inc.add_load(collection, "a", statements(spark, entity("a", "C")))
    with pytest.raises(Conflict):
        inc.add_load(collection, "b", statements(spark, entity("b", "C")))
    found = inc.open_collection(spark, collection.path)
    assert (found.version, set(found.loads)) == (mine.version, {"a"}) and flat(found.read_documents()) == flat(mine.read_documents())


def test_roots_that_show_no_change_are_not_read(spark, tmp_path):
    """The folders a refresh has no business with are taken away before it."""
    some = entity("r1", "R", ("name", "x", "literal")) + entity("r2", "R", ("name", "y", "literal"))
    for i in range(40):
        some += entity(f"c{i}", "C", ("in", "r1" if i == 3 else "r2", "iri")) + entity(f"p{i}", "P", ("of", f"c{i}", "iri"))
    collection = inc.add_load(inc.create_collection(spark, str(tmp_path / "c"), buckets=32), "a", statements(spark, some))
    framed = inc.create_framed(collection, str(tmp_path / "f"), {"people": FRAME}, buckets=32)
    changed = entity("r1", "R", ("name", "new", "literal"))
    later = inc.replace_load(collection, "a", statements(spark, [s for s in some if s[0] != "r1"] + changed))

    keys = spark.createDataFrame([("r1",), ("c3",), ("p3",)], "uri STRING")
    needed = set(later.documents.touched(keys))
    for bucket, folder in later.documents.folders.items():
        if bucket not in needed:
            shutil.rmtree(os.path.join(later.documents.path, folder, f"_bucket={bucket}"))
    new = inc.refresh_framed(framed, later)
    (mine,) = framed.roots["people"].touched(spark.createDataFrame([("p3",)], "uri STRING"))
    assert {b for b, f in new.roots["people"].folders.items() if f != framed.roots["people"].folders[b]} == {mine}
    names = {r["uri"]: r["of"][0]["in"][0]["props"]["name"][0]["v"] for r in new.read("people").collect()}
    assert names == {f"p{i}": "new" if i == 3 else "y" for i in range(40)}
    assert inc.refresh_framed(new, later) is new


def test_expired_versions_leave_the_last(spark, tmp_path):
    collection = inc.create_collection(spark, str(tmp_path / "c"), buckets=2)
    for k in "abc":
        collection = inc.add_load(collection, k, statements(spark, entity(k, "C")))
    expected = flat(collection.read_documents())
    inc.expire_collection(spark, collection.path)
    found = inc.open_collection(spark, collection.path)
    assert flat(found.read_documents()) == expected
    with pytest.raises(FileNotFoundError):
        inc.open_collection(spark, collection.path, 1)


def test_frames_round_trip_as_json():
    for frame in (FRAME, BACK, Frame("X", keep=())):
        assert Frame.from_dict(frame.to_dict()) == frame


def test_reserved_columns_are_those_of_documents():
    assert set(RESERVED) <= set(inc.NODES.names)
