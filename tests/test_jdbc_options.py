"""What the JDBC readers are given; reading itself needs a database."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerday.sources.contacts import contacts_jdbc_options
from ledgerday.sources.ledger import jdbc_options


def test_plain_read_is_one_query():
    assert jdbc_options("jdbc:x", "view") == {"url": "jdbc:x", "dbtable": "view", "fetchsize": "10000"}


def test_ranges_are_weeks_of_the_bounds():
    got = jdbc_options("jdbc:x", "view", date_bounds=("2024-01-01", dt.date(2024, 1, 31)), properties={"user": "u", "fetchsize": "5"})
    assert got == {
        "url": "jdbc:x", "dbtable": "view", "fetchsize": "5", "user": "u", "partitionColumn": "vrdate",
        "lowerBound": "2024-01-01", "upperBound": "2024-02-01", "numPartitions": "5",
    }


def test_no_more_ranges_than_days():
    assert jdbc_options("u", "t", date_bounds=("2024-03-05", "2024-03-05"), num_partitions=8)["numPartitions"] == "1"
    assert jdbc_options("u", "t", date_bounds=("2024-03-01", "2024-03-05"), num_partitions=3)["numPartitions"] == "3"
    with pytest.raises(ValueError, match="bounds"):
        jdbc_options("u", "t", date_bounds=("2024-03-05", "2024-03-01"))


def test_contacts_are_read_by_ranges_of_a_number_if_one_is_given():
    assert contacts_jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "fetchsize": "10000"}
    got = contacts_jdbc_options("u", "t", number="contact_id", bounds=(1, 90_000), num_partitions=4)
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("contact_id", "1", "90000", "4")
