"""Loads delimited files into a table: ``spark-submit load_job.py FILE TABLE [options]``."""

import sys

from loadmason.plans.job import main

sys.exit(main())
