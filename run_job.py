"""``spark-submit run_job.py clean|train|precompute|publish|watch --help``"""

from rateweave.jobs import main

if __name__ == "__main__":
    main()
