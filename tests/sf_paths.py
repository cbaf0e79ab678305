"""Where the driver's tables lie (a module of its own name: every test folder has a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
