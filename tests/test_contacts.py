import os

from ledgerline.plans.contacts import contacts_with_full_name, read_contacts
from ledgerline.plans.inspect import physical_plan

# own rows with the contacts schema; edge cases from the fixture list
CSV = "\n".join([
    "last_name,first_name,comment",
    "Quill,Ada,Paid 3 invoices today",
    "Brook,Sam,No numbers in this one",
    "Ames,Lee,",
    "Cole,,Room 12 is free",
    'Drew,Kim,"Said ""call me at 5"""',
    "Ford,Joe,Left early, back at 4",
]) + "\n"


def load(spark, scratch, text=CSV, escape=None):
    path = os.path.join(scratch, "contacts.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return read_contacts(spark, path, escape=escape)


def test_all_columns_are_strings(spark, scratch):
    df = load(spark, scratch)
    assert [t for _, t in df.dtypes] == ["string"] * 3


def test_filter_full_name_and_sort(spark, scratch):
    rows = contacts_with_full_name(load(spark, scratch)).collect()
    # null comment and comment without a digit drop; "Ford" keeps only "Left early" -> no digit
    assert [r.last_name for r in rows] == ["Cole", "Drew", "Quill"]
    by = {r.last_name: r for r in rows}
    assert by["Quill"].full_name == "Quill, Ada"
    assert by["Cole"].full_name is None              # null part -> null name, row kept
    # default backslash escape: the doubled quotes are not unescaped
    assert '""call me at 5""' in by["Drew"].comment


def test_unquoted_comma_truncates_comment(spark, scratch):
    rows = {r.last_name: r.comment for r in load(spark, scratch).collect()}
    assert rows["Ford"] == "Left early"


def test_escape_parameter(spark, scratch):
    rows = {r.last_name: r.comment for r in load(spark, scratch, escape='"').collect()}
    assert rows["Drew"] == 'Said "call me at 5"'


def test_sort_nulls_first_and_regex_find(spark):
    df = spark.createDataFrame(
        [(None, "x", "a1"), ("b", "y", "22"), ("a", "z", "x9y")],
        "last_name string, first_name string, comment string")
    out = contacts_with_full_name(df).collect()
    assert [r.last_name for r in out] == [None, "a", "b"]


def test_regex_filter_is_native(spark, scratch):
    plan = physical_plan(contacts_with_full_name(load(spark, scratch), sort=False))
    assert "RLIKE(comment" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
