"""Where the repository and the test tables are."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
