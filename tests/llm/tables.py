"""Where the small tables lie."""

TINY = "/root/testdata/sf0.001"
