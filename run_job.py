"""Launcher for spark-submit: ``spark-submit --py-files salesmart.zip run_job.py --drop ... --out ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.plans.job import main  # noqa: E402

if __name__ == "__main__":
    main()
