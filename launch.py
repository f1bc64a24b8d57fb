"""Entry point for spark-submit: ``spark-submit launch.py clusterer|publisher ...``."""

from ratingstream.jobs import main

if __name__ == "__main__":
    main()
