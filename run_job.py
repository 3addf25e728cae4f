"""Entry point of the jobs for spark-submit; see ``siltstone/jobs.py``."""

from siltstone.jobs import main

if __name__ == "__main__":
    main()
