"""Entry script: ``spark-submit --py-files postlens.zip submit.py etl --input ... --output ...``"""

from postlens.cli import main

if __name__ == "__main__":
    main()
