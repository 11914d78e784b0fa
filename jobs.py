"""spark-submit launcher for the scheduled jobs (see liqspark/plans/cli.py).

    spark-submit --py-files liqspark.zip jobs.py run --partition-date 2024-03-29 ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from liqspark.plans.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
