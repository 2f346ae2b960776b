"""``python -m bourse ...`` runs the bronze -> silver -> gold job."""

from bourse.plans.job import main

main()
