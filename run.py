"""spark-submit entry of the jobs; see tickspan/jobs.py."""

from tickspan.jobs import main

if __name__ == "__main__":
    main()
