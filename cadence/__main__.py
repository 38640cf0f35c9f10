"""``python -m cadence ...`` runs the daily job (see ``cadence.plans.job``)."""

import sys

from cadence.plans.job import main

sys.exit(main())
