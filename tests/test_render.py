import hashlib
import json

import pytest
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators.hashing import hash_rows, with_key_hash

NAMES = ["id", "name", "val"]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "row, digest",
    [
        (("1", "a", "x"), "f890a87547c7e557fd555dc0a059d147"),
        (("1", "", "x"), "e54b1797d26b68bbdd9cbea2991ba301"),
    ],
)
def test_labelled_digest(spark, row, digest):
    df = spark.createDataFrame([row], "id string, name string, val string")
    text = render.render_labelled({"Id": "id", "Name": "name", "Val": "val"})
    assert df.select(render.digest(text)).first()[0] == digest


def test_labelled_null_prints_null_and_bars_are_ambiguous(spark):
    df = spark.createDataFrame(
        [("1", None, "x"), ("2", "a|Val:b", "c"), ("2", "a", "b|Val:c")],
        "id string, name string, val string",
    )
    text = render.render_labelled({"Id": "id", "Name": "name", "Val": "val"})
    got = [r[0] for r in df.select(text).collect()]
    assert got == ["Id:1|Name:null|Val:x", "Id:2|Name:a|Val:b|Val:c", "Id:2|Name:a|Val:b|Val:c"]


def test_json_goldens(records):
    hashed = hash_rows(records(['{"id":1,"name":"a","val":"x"}']), NAMES, ["id"]).first()
    assert hashed.keys == "1|"
    assert hashed.key_hash == "77529b68d130d125ff07a534a7b69adb"
    assert hashed.value_hash == "aef608f99d76f759f6af08a47b2b1e7e"


@pytest.mark.parametrize(
    "record, digest",
    [
        ('{"id":"1"}', "cee25b4a1400f0d237ac1226cc2db187"),
        ('{"id":null}', "57e9e4f0d93e1acfd21479b6aaaa32b7"),
        ('{"x":1}', "57e9e4f0d93e1acfd21479b6aaaa32b7"),
    ],
)
def test_json_key_goldens(records, record, digest):
    assert with_key_hash(records([record]), ["id"]).first().key_hash == digest


# What a tree-model JSON writer prints for the field "a" of each record.
PRINTED = {
    '{"a":1}': "1",
    '{"a":"1"}': '"1"',
    '{"a":null}': "null",
    '{"b":1}': "null",
    '{"a":"null"}': '"null"',
    '{"a":true}': "true",
    '{"a":1.0}': "1.0",
    '{"a":100.00}': "100.0",
    '{"a":-0.0}': "-0.0",
    '{"a":1e5}': "100000.0",
    '{"a":1E20}': "1.0E20",
    '{"a":123456789012345678901234567890}': "123456789012345678901234567890",
    '{"a":{"b":1, "a":  2}}': '{"b":1,"a":2}',
    '{"a":[1, "x",null]}': '[1,"x",null]',
    '{"a":"x\\"|y"}': '"x\\"|y"',
    '{"a":"\\u00e9\\n\\u0001"}': '"é\\n\\u0001"',
    '{"a":""}': '""',
    "[1]": "null",
    '[{"a":5}]': "null",
    '"text"': "null",
    "5": "null",
    '{"x":{"a":9}}': "null",
}


def test_json_field_of_every_kind(records):
    df = records(list(PRINTED))
    got = {r[0]: r[1] for r in df.select("value", render.json_field("a")).collect()}
    assert got == PRINTED


def test_field_names_with_dots_spaces_and_brackets(records):
    df = records(['{"a.b":1,"a b":"x","a[0]":2.50,"a":{"b":3}}'])
    fields = ["a.b", "a b", "a[0]"]
    assert df.select(render.render_json(render.field_texts(df, fields))).first()[0] == '1|"x"|2.5|'


@pytest.mark.parametrize("name", ["", "a'b", 'a"b', "a?b", "a\\b"])
def test_unaddressable_names_are_rejected(name):
    with pytest.raises(ValueError):
        render.json_field(name)


def test_malformed_record_fails_or_is_null(records):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        hash_rows(records(["not json"]), NAMES, ["id"]).collect()
    assert records(["not json"], strict=False).first().v is None


def test_text_goldens(records):
    hashed = hash_rows(records(['{"x":1}']), NAMES, ["id"], mode="text").first()
    assert hashed.keys == "id||name||val||"
    assert hashed.key_hash == "7e5f96316daf01dc5194b1fa9e425e92"
    assert hashed.value_hash == "2edf2958166561c5c08cd228e53bbcdc"


def test_text_keeps_strings_only(records):
    df = records(['{"a":"s","b":1,"c":null,"e":"null"}'])
    names = ["a", "b", "c", "d", "e"]
    assert df.select(render.render_text(names)).first()[0] == "s||||null|"
    key = df.select(render.render_text(names, key=True)).first()[0]
    assert key == "a|s|b|null|c|null|d||e|null|"


def test_typed_columns_render_like_their_json(spark, records):
    df = spark.createDataFrame(
        [(1, 'q"|', 2.5, True, None, [1, 2])],
        "i int, s string, d double, b boolean, n string, l array<int>",
    )
    names = df.columns
    typed = df.select(render.render_json(render.field_texts(df, names))).first()[0]
    parsed = records([df.select(F.to_json(F.struct("*"))).first()[0]])
    assert parsed.select(render.render_json(render.field_texts(parsed, names))).first()[0] == typed
    assert typed == '1|"q\\"|"|2.5|true|null|[1,2]|'


def test_key_text(records):
    df = records(['{"a":"x","b":1}'])
    assert df.select(render.key_text(df, ["a", "b", "c"])).first()[0] == "x|1|null"


def test_record_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(render.record_text(df.columns)).first()[0] == "(a,null,3)"


def test_typed_text_is_escaped_as_in_json(spark):
    texts = ["", "plain", 'q"q', "b\\b", "t\tn\nr\r", "\x01\x1f", "\x7f\u2028é", "a/b|c", "x0"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", render.field_texts(df, ["s"])[0]).collect()
    assert [r[1] for r in got] == [json.dumps(t, ensure_ascii=False) for t in texts[:5]] + [
        '"\\u0001\\u001F"', '"\x7f\u2028é"', '"a/b|c"', '"x0"',
    ]


def test_maps_print_in_order_of_their_keys(spark):
    df = spark.sql(
        "select map('b', 2, 'a', 1) as m, array(map('y', map(2, 0, 1, 0))) as n, named_struct('x', map('d', 1, 'c', 2)) as s"
    )
    assert df.select(*render.field_texts(df, ["m", "n", "s"])).first()[:] == (
        '{"a":1,"b":2}', '[{"y":{"1":0,"2":0}}]', '{"x":{"c":2,"d":1}}',
    )


def test_a_text_column_named_like_the_parsed_form_is_plain(spark):
    df = spark.createDataFrame([("k", "x")], "Id string, v string")
    assert df.select(*render.field_texts(df, ["id", "v"])).first()[:] == ('"k"', '"x"')
