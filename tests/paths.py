"""Where the tests find the generated tables."""

SF_SMALL = "/root/testdata/sf0.001"
