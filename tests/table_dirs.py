"""Folders of the given tables, under a name that no other test folder uses."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
