import sys

from courtside.cli import main

sys.exit(main())
