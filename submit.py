"""For spark-submit: ``spark-submit --py-files terracelake.zip submit.py <job> ...``."""

from terracelake.cli import main

if __name__ == "__main__":
    main()
