from __future__ import annotations

import json

from shopfloor import schemas as S
from shopfloor.operators.tickets import custom_field_codes, label_custom_fields, label_table
from shopfloor.sources import read_json_documents

DOCUMENT = {
    "custom_fields": [
        {"values": [{"id": 1, "lable": "new"}, {"id": 2, "lable": "called"}], "note": "x"},
        {"values": [{"id": 7, "lable": "taken"}]},
    ]
}


def test_codes(spark, rows):
    fields = spark.createDataFrame(
        [
            (1, 4871, "2"), (1, 4893, "7"),
            (2, 4871, "1"),
            (3, 4871, "1"), (3, 4871, "1"),  # repeats add up
            (4, 4893, "n/a"), (4, 1, "9"),
            (5, 4871, None),
        ],
        S.TICKET_CUSTOM_FIELDS_EAV,
    )
    assert rows(custom_field_codes(fields)) == [
        (1, 2, 7), (2, 1, None), (3, 2, None), (4, None, None), (5, None, None),
    ]


def test_labels_by_position(spark, tmp_path, rows):
    (tmp_path / "fields.json").write_text(json.dumps(DOCUMENT, indent=1))
    documents = read_json_documents(spark, str(tmp_path / "fields.json"), S.CUSTOM_FIELDS_DOCUMENT)
    assert rows(label_table(documents, 0)) == [(1, "new"), (2, "called")]
    assert rows(label_table(documents, 1)) == [(7, "taken")]
    assert rows(label_table(documents, 2)) == []


def test_empty_and_missing_values(spark, rows):
    documents = spark.createDataFrame(
        [([{"values": []}, {"values": None}],), ([],), (None,)], S.CUSTOM_FIELDS_DOCUMENT
    )
    assert rows(label_table(documents, 0)) == [] == rows(label_table(documents, 1))


def test_label_lookup(spark, rows):
    codes = spark.createDataFrame(
        [(1, 2.0, 7.0), (2, 1.0, None), (3, 99.0, 8.0), (4, 2.5, 7.0)],
        "ticket_id bigint, trang_thai_cham_soc double, trang_thai_tiep_nhan double",
    )
    care = spark.createDataFrame([(1, "new"), (2, "called")], "id bigint, lable string")
    receive = spark.createDataFrame([(7, "taken")], "id bigint, lable string")
    assert rows(label_custom_fields(codes, care, receive)) == [
        (1, "called", "taken"), (2, "new", None), (3, None, None), (4, None, "taken"),
    ]


def test_large_ids_match_exactly(spark, rows):
    big = 2**60 + 1
    fields = spark.createDataFrame([(1, 4871, str(big)), (2, 4871, str(big - 1)), (3, 4893, "7")], S.TICKET_CUSTOM_FIELDS_EAV)
    care = spark.createDataFrame([(big, "right"), (big + 1, "wrong")], "id bigint, lable string")
    receive = spark.createDataFrame([(7, "taken")], "id bigint, lable string")
    assert rows(label_custom_fields(custom_field_codes(fields), care, receive)) == [
        (1, "right", None), (2, None, None), (3, None, "taken"),
    ]
