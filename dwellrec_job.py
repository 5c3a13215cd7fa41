"""spark-submit launcher: ``spark-submit dwellrec_job.py evaluate ...``.

Only the driver runs Python (every operator is JVM-side), so executors need
no copy of the package.
"""

import sys

from dwellrec.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
