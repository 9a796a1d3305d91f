"""``python -m sigshape <job> ...``: the job command line (see ``plans.jobs``)."""

from .plans.jobs import main

if __name__ == "__main__":
    main()
