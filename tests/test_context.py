from helpers import plan, rows, statements
from ldspark.operators import apply_context, context_documents, parse_contexts
from ldspark.plans import RDF_TYPE


def test_only_object_terms_with_an_identifier_count(spark):
    files = spark.createDataFrame(
        [
            ('{"@context": {"name": {"@id": "v:name", "@type": "@id"}, "plain": "v:plain", "no": {"@type": "@id"}}}',),
            ('{"other": {"name": {"@id": "v:x"}}}',),
            ("{broken",),
            ('{"@context": "http://elsewhere.example/"}',),
        ],
        "text STRING",
    )
    assert rows(parse_contexts(files)) == [("name", "v:name")]


def test_properties_and_classes_are_shortened_and_values_are_not(spark):
    st = statements(
        spark,
        [
            ("u:1", RDF_TYPE, "v:C", "type"), ("u:1", "v:name", "v:C", "literal"),
            ("u:1", "v:link", "v:C", "iri"), ("u:1", "v:unknown", "x", "literal"),
        ],
    )
    context = {"C": "v:C", "name": "v:name", "alias": "v:name", "link": "v:link"}
    want = [
        ("u:1", RDF_TYPE, "C", "type"), ("u:1", "alias", "v:C", "literal"),
        ("u:1", "link", "v:C", "iri"), ("u:1", "v:unknown", "x", "literal"),
    ]
    assert rows(apply_context(st, context)) == sorted(want, key=repr)
    table = spark.createDataFrame(list(context.items()), "term STRING, iri STRING")
    assert rows(apply_context(st, table)) == sorted(want, key=repr)


def test_a_mapping_needs_no_join(spark):
    st = statements(spark, [("u:1", "v:name", "x", "literal")])
    text = plan(apply_context(st, {"name": "v:name"}))
    assert "Join" not in text and "Exchange" not in text
    assert rows(apply_context(st, {})) == [("u:1", "v:name", "x", "literal")]


CONTEXT = {"C": "v:C", "name": "http://v/name", "tag": 'v:"q"'}


def renamed(spark, *texts, **options):
    records = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key STRING, value STRING")
    documents, rejects = context_documents(records, CONTEXT, **options)
    assert "Exchange" not in plan(documents)
    return [r["value"] for r in documents.orderBy("key").collect()], [r["key"] for r in rejects.orderBy("key").collect()]


def test_documents_keep_everything_but_names_and_types(spark):
    inline = '"@context": {"name": {"@id": "http://v/name", "@type": "v:C"}, "x": "http://v/name"}'
    texts = [
        '{"age":5,"ok":true,"price":1.50,"tags":["b","a","a"],"none":null}',
        '{"http://v/name" : "v:C", "@type": "v:C", "in": [{"http:\\/\\/v\\/name": {"@type": ["v:C", "D"]}}]}',
        '{"v:\\"q\\"": "\\"http://v/name\\": 1", "e\\\\": "\\\\", "@type" : [ ]}',
        "{" + inline + ', "http://v/name": 1}',
        "{}",
    ]
    found, rejects = renamed(spark, *texts)
    assert rejects == []
    assert found == [
        texts[0],
        '{"name" : "v:C", "@type": "C", "in": [{"name": {"@type": ["C", "D"]}}]}',
        '{"tag": "\\"http://v/name\\": 1", "e\\\\": "\\\\", "@type" : [ ]}',
        "{" + inline + ', "name": 1}',
        "{}",
    ]


def test_identifiers_may_be_renamed_outside_an_inline_context(spark):
    text = '{"@context": {"a": {"@id": "b"}}, "@id": "u:1", "in": {"@id": "u:2"}}'
    found, _ = renamed(spark, text, output_id_field="uri")
    assert found == ['{"@context": {"a": {"@id": "b"}}, "uri": "u:1", "in": {"uri": "u:2"}}']


def test_text_that_is_no_document_is_a_reject(spark):
    found, rejects = renamed(spark, '{"a": 1}', "{broken", '["a"]', None, "")
    assert found == ['{"a": 1}'] and rejects == ["1", "2", "3", "4"]


def test_long_documents_do_not_overflow(spark):
    text = '{"http://v/name": "' + "x\\\\y" * 50_000 + '", "l": [' + ",".join('"s"' for _ in range(20_000)) + "]}"
    (found,), _ = renamed(spark, text)
    assert found == text.replace("http://v/name", "name")
