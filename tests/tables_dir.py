"""Where the smallest driver tables are."""

SF_SMALL = "/root/testdata/sf0.001"
