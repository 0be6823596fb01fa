from __future__ import annotations

import itertools

import pytest
from pyspark.sql.types import DataType, NullType, StructType

from eventmart import config
from eventmart.sources import schema_store
from eventmart.sources.landing import infer_csv_schema
from eventmart.sources.schema_store import keep_schema, last_schema, merged, remembered_schema, versions, widest

TYPES = "tinyint, smallint, int, bigint, float, double, decimal(5,2), decimal(38,0), date, timestamp, string, boolean, array<int>, array<string>"


@pytest.fixture
def types(spark):
    fields = ",".join(f"c{i} {t}" for i, t in enumerate(TYPES.replace("(5,2)", "(5;2)").replace("(38,0)", "(38;0)").split(", ")))
    return [f.dataType for f in StructType.fromDDL(fields.replace(";", ","))] + [NullType()]


def name(t: DataType) -> str:
    return t.simpleString()


def test_types_form_a_lattice(types):
    for a, b in itertools.product(types, types):
        assert name(widest(a, b)) == name(widest(b, a))
        assert name(widest(a, a)) == name(a)
        both = widest(a, b)
        assert name(widest(a, both)) == name(both) == name(widest(both, b))


def test_widest_of_some(spark):
    def of(a, b):
        return name(widest(StructType.fromDDL(f"a {a}")["a"].dataType, StructType.fromDDL(f"a {b}")["a"].dataType))

    assert [of("int", "bigint"), of("int", "double"), of("date", "timestamp"), of("date", "int")] == ["bigint", "double", "timestamp", "string"]
    assert of("decimal(5,2)", "int") == "decimal(12,2)" and of("bigint", "double") == "string"
    assert of("struct<a:int>", "struct<a:bigint,b:string>") == "struct<a:bigint,b:string>"


def test_merged_keeps_old_columns_first_and_ignores_case(spark):
    old, new = StructType.fromDDL("b int, A string"), StructType.fromDDL("c date, a int, B bigint")
    assert merged(old, new).simpleString() == "struct<b:bigint,A:string,c:date>"


def test_second_read_infers_nothing_and_new_files_widen(spark, tmp_path, monkeypatch):
    place, land = f"{tmp_path}/schema", tmp_path / "users"
    land.mkdir()
    (land / "a.csv").write_text("user_id,n,since\n1,5,2024-01-01\n")
    first = remembered_schema(spark, f"{land}/*.csv", place)
    assert first.simpleString() == "struct<user_id:int,n:int,since:date>"
    assert last_schema(spark, place) == (0, first)
    # The files may be gone: nothing of them is read.
    assert remembered_schema(spark, f"{tmp_path}/gone", place) == first

    (land / "b.csv").write_text("user_id,since,extra\n1,2024-01-01 10:00:00,x\n5000000000,2024-01-01 10:00:00,y\n")
    wider = remembered_schema(spark, f"{land}/b.csv", place, new_files=True)
    assert wider.simpleString() == "struct<user_id:bigint,n:int,since:timestamp,extra:string>"
    assert last_schema(spark, place) == (1, wider) and remembered_schema(spark, "gone", place) == wider
    # Files that fit write no version; neither does a narrower schema.
    remembered_schema(spark, f"{land}/a.csv", place, new_files=True)
    keep_schema(spark, place, infer_csv_schema(spark, f"{land}/a.csv"))
    assert versions(spark, place).count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        monkeypatch.setattr(schema_store, "last_schema", lambda *_: (0, first))
        keep_schema(spark, place, wider)  # another writer was faster


def test_the_configured_place_is_used(spark, tmp_path):
    land = tmp_path / "land" / "users"
    land.mkdir(parents=True)
    (land / "a.csv").write_text("user_id,n\n1,5\n")
    props = config.default_properties(spark, f"{tmp_path}/land", f"{tmp_path}/schemas")
    assert config.landing_schema(props, "users").simpleString() == "struct<user_id:int,n:int>"
    assert last_schema(spark, f"{tmp_path}/schemas/users")[0] == 0
    (land / "b.csv").write_text("user_id,n\nx,5\n")
    assert config.landing_schema(props, "users").simpleString() == "struct<user_id:int,n:int>"
    assert config.landing_schema(props, "users", new_files=f"{land}/b.csv").simpleString() == "struct<user_id:string,n:int>"
