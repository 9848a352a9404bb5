"""``python -m hourglass …`` runs the whole study (see ``hourglass.plans.study``)."""

from .plans.study import main

main()
