import datetime
import re

import pytest

from spanwright.llm.pseudonyms import pseudonymised


def replaced(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(pseudonymised(frame, "key", counts=True).collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize(("value", "form", "order"), [
    ("12/31/1999", r"(\d{2})/(\d{2})/(\d{4})", "%m/%d/%Y"),
    ("3/25/1999", r"(\d{1,2})/(\d{2})/(\d{4})", "%m/%d/%Y"),
    ("3/5/1999", r"(\d{1,2})/(\d{1,2})/(\d{4})", "%d/%m/%Y"),
    ("3.5.1999", r"(\d{1,2})\.(\d{1,2})\.(\d{4})", "%d.%m.%Y"),
    ("1999/12/31", r"(\d{4})/(\d{2})/(\d{2})", "%Y/%m/%d"),
])
def test_dates_in_other_forms(spark, value, form, order):
    row = replaced(spark, [f"on {value}."])[0]
    found = re.fullmatch(rf"on ({form})\.", row.text)
    assert row.n_date == 1 and found and found[1] != value
    datetime.datetime.strptime(found[1], order)


def test_cards_in_groups_of_four_six_five(spark):
    row = replaced(spark, ["pay 3782 822463 10005 now"])[0]
    found = re.fullmatch(r"pay (\d{4} \d{6} \d{5}) now", row.text)
    assert row.n_card == 1 and found and found[1] != "3782 822463 10005"
    digits = [int(c) for c in reversed(found[1].replace(" ", ""))]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_days_that_are_only_month_first_stay_so_and_apart(spark):
    first = datetime.date(1900, 1, 1)
    days = [d for i in (*range(400), *range(36400, 36900), *range(72700, 73080)) if (d := first + datetime.timedelta(days=i)).day > 12]
    found = replaced(spark, [f"{d:%m/%d}/{d.year}" for d in days])
    new = {datetime.datetime.strptime(r.text, "%m/%d/%Y").date() for r in found}
    assert len(new) == len(days) and all(d.day > 12 and first <= d < datetime.date(2100, 2, 1) for d in new)


def test_what_is_no_day_stays(spark):
    texts = ["31/02/1999", "02/30/1999", "13/13/1999", "12/31/1850", "0/5/1999", "1999/13/01", "1/2/19990"]
    assert [r.text for r in replaced(spark, texts)] == texts
