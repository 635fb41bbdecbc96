"""Cluster entry point: ``spark-submit --py-files matchlog.zip submit.py LOGS --out DIR``."""

from matchlog.job import main

if __name__ == "__main__":
    main()
