import sys

from changeloom.cli import main

sys.exit(main())
